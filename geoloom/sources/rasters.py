"""Rasters written from tables of cells, and map tiles written as placed rasters; one file a task row."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import grids
from geoloom.operators.points import GROUND, NOISE
from geoloom.sources import las
from geoloom.sources.geotiff import Tile, read_header, read_tile, tiles_of, write_geotiff

RESULT = "raster_id string, path string, valid long, error string"
#: Cells of the largest raster that a task will hold: 4 GB of float32.
MOST_CELLS = 1 << 30


def write_cells(cells: DataFrame, places: DataFrame, folder: str, suffix: str = "", masked: bool = False) -> DataFrame:
    """(raster_id, path, valid, error): <raster_id><suffix>.tif for each row of places, float32 with NaN where no cell is.

    cells: (raster_id, row, col, value), each place once; null and outlying cells are left out. places: (raster_id,
    width, height, left, top, pixel, epsg or null). Cells travel as one packed row per line of a raster, so a task holds
    one raster; rasters of more than MOST_CELLS cells are refused. Files appear whole, and a task that runs again writes
    the same bytes. A raster without cells is written empty. places may have tags, a map that becomes the raster's metadata;
    masked adds a mask of the cells that are there.
    """
    places = places if "tags" in places.columns else places.withColumn("tags", F.lit(None).cast("map<string,string>"))
    fixed = ["raster_id", "width", "height", "left", "top", "pixel", "epsg", "tags"]
    inside = (F.col("row") >= 0) & (F.col("col") >= 0) & F.col("value").isNotNull()
    lines = cells.where(inside).groupBy("raster_id", "row").agg(F.collect_list(F.struct("col", "value")).alias("line"))
    joined = places.select(*fixed).join(lines, "raster_id", "left")
    schema = joined.select(*fixed, "row", F.col("line.col").alias("cols"), F.col("line.value").cast("array<double>").alias("values"))

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        one = frame.iloc[0]
        width, height, name = int(one["width"]), int(one["height"]), str(one["raster_id"])
        if width * height > MOST_CELLS or min(width, height) < 1:
            return pd.DataFrame([(name, None, 0, f"{width} by {height} cells")], columns=["raster_id", "path", "valid", "error"])
        grid = np.full((height, width), np.nan, np.float32)
        for row, cols, values in zip(frame["row"], frame["cols"], frame["values"], strict=True):
            if cols is not None and row < height:
                at = np.asarray(cols)
                fits = at < width
                grid[int(row), at[fits]] = np.asarray(values)[fits]
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f"{name}{suffix}.tif")
        write_geotiff(path, grid, one["left"], one["top"], one["pixel"], epsg=None if pd.isna(one["epsg"]) else int(one["epsg"]), tags=None if one["tags"] is None else dict(one["tags"]), mask=np.isfinite(grid) if masked else None)
        return pd.DataFrame([(name, path, int(np.isfinite(grid).sum()), None)], columns=["raster_id", "path", "valid", "error"])

    return schema.groupBy("raster_id").applyInPandas(write, RESULT)


def headers(files: DataFrame) -> DataFrame:
    """files (raster_id, path and others) with bands and the grid of each raster: a to f, width, height, crs. Files that cannot be read have an error."""
    grid = [T.StructField("bands", T.IntegerType()), *(T.StructField(k, T.DoubleType()) for k in "abcdef"), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("crs", T.StringType()), T.StructField("error", T.StringType())]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path in frame["path"]:
                try:
                    h = read_header("/" + path.removeprefix("file:").lstrip("/"))
                    out.append((h.bands, h.pixel[0], 0.0, h.bounds[0], 0.0, -h.pixel[1], h.bounds[3], h.width, h.height, h.crs, None))
                except (OSError, ValueError) as e:
                    out.append((*[None] * 10, str(e)))
            yield pd.concat([frame.reset_index(drop=True), pd.DataFrame(out, columns=[f.name for f in grid])], axis=1)

    return files.mapInPandas(run, T.StructType([*files.schema.fields, *grid]))


def read_cells(files: DataFrame, band: int = 1, parts: int = 32) -> DataFrame:
    """(raster_id, row, col, value) of files (raster_id, path); a task reads tiles, not whole rasters."""
    kind = files.schema["raster_id"].dataType

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(r, t.path, t.row, t.col, t.offset, t.count) for r, path in zip(frame["raster_id"], frame["path"], strict=True) for t in tiles_of("/" + path.removeprefix("file:").lstrip("/"), band)]
            yield pd.DataFrame(rows, columns=["raster_id", "path", "row", "col", "offset", "count"])

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                rows, cols, values, bad = read_tile(Tile(r.path, int(r.row), int(r.col), int(r.offset), int(r.count)), band)
                yield pd.DataFrame({"raster_id": r.raster_id, "row": rows[~bad], "col": cols[~bad], "value": values[~bad]})

    tiles = files.select("raster_id", "path").mapInPandas(cut, T.StructType([T.StructField("raster_id", kind), *(T.StructField(n, t) for n, t in (("path", T.StringType()), ("row", T.IntegerType()), ("col", T.IntegerType()), ("offset", T.LongType()), ("count", T.LongType())))]))
    cells = T.StructType([T.StructField("raster_id", kind), T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), T.StructField("value", T.DoubleType())])
    return tiles.repartition(parts).mapInPandas(read, cells)


def surface(path: str, fallback: str | None = None, product: str = "dsm", resolution: float = 1.0, keep: bool = False, excluded: tuple[int, ...] = NOISE) -> str:
    """A point cloud as a raster beside it, <stem>_<product>.tif; the cloud goes unless it is to be kept. The highest return of a cell for dsm, the lowest on the ground for dtm."""
    head = las.read_header(path)
    if head.packed:
        raise ValueError(f"{path} is compressed; only LAS is read")
    code = las.system_of(head, fallback)
    kept: list[np.ndarray] = []
    for at in range(0, head.count, las.POINTS_A_PARTITION):
        x, y, z, kind = las.read_points(path, head, at, min(las.POINTS_A_PARTITION, head.count - at))
        use = kind == GROUND if product == "dtm" else ~np.isin(kind, excluded)
        kept.append(np.stack([x[use], y[use], z[use]]))
    points = np.concatenate(kept, axis=1) if kept else np.zeros((3, 0))
    if not points.shape[1]:
        raise ValueError(f"{path} has no point for {product}")
    (minx, miny, _), (maxx, maxy, _) = points.min(1), points.max(1)
    width, height = max(1, int(np.ceil((maxx - minx) / resolution))), max(1, int(np.ceil((maxy - miny) / resolution)))
    col = np.clip(((points[0] - minx) / resolution).astype(np.int64), 0, width - 1)
    row = np.clip(((maxy - points[1]) / resolution).astype(np.int64), 0, height - 1)
    grid = np.full(height * width, -np.inf if product == "dsm" else np.inf, np.float32)
    (np.maximum if product == "dsm" else np.minimum).at(grid, row * width + col, points[2].astype(np.float32))
    out = surface_path(path, product)
    write_geotiff(out, np.where(np.isinf(grid), np.nan, grid).reshape(height, width), float(minx), float(maxy), resolution, epsg=int(code.rpartition(":")[2]))
    if not keep:
        os.remove(path)
    return out


def surface_path(path: str, product: str) -> str:
    return f"{os.path.splitext(path)[0]}_{product}.tif"


def write_tiles(images: DataFrame, folder: str) -> DataFrame:
    """(raster_id, path, valid, error): map tiles as three bands in Web Mercator. images is what the image format reads.

    The zoom, column and row come from the file's name. Images that cannot be decoded and names without a place give
    an error; grey images get three equal bands, and transparency is left out.
    """
    name = F.regexp_extract("image.origin", r"([^/]*?)(?:\.[^./]*)?$", 1)
    zoom, x, y = grids.tile_name_parts(name)
    rows = images.select(name.alias("raster_id"), zoom.alias("z"), x.alias("x"), y.alias("y"), "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if any(pd.isna(v) for v in (r.z, r.x, r.y)):
                    out.append((r.raster_id, None, 0, "the name has no place"))
                elif r.channels not in (1, 3, 4) or min(r.width, r.height) < 1:
                    out.append((r.raster_id, None, 0, "no image"))
                else:
                    pixels = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels)
                    bands = np.repeat(pixels, 3, axis=2) if r.channels == 1 else pixels[:, :, 2::-1]  # stored blue first
                    side = 2 * grids.HALF_WORLD / (1 << int(r.z))
                    os.makedirs(folder, exist_ok=True)
                    path = os.path.join(folder, f"{r.raster_id}.tif")
                    write_geotiff(path, np.ascontiguousarray(bands.transpose(2, 0, 1)), r.x * side - grids.HALF_WORLD, grids.HALF_WORLD - r.y * side, side / r.width, None, 3857, side / r.height)
                    out.append((r.raster_id, path, r.width * r.height, None))
            yield pd.DataFrame(out, columns=["raster_id", "path", "valid", "error"])

    return rows.mapInPandas(run, RESULT)


def raster_regions(files: DataFrame) -> DataFrame:
    """(region_id, bounds, crs, height, width, pixel, path) of raster files (stem, path) by their headers; a raster without a system is an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for stem, path in zip(frame["stem"], frame["path"], strict=True):
                plain = path.removeprefix("file:")
                head = read_header("/" + plain.lstrip("/"))
                if head.crs is None:
                    raise ValueError(f"{plain} names no coordinate system")
                out.append((stem, *head.bounds, head.crs, head.height, head.width, *head.pixel, path))
            yield pd.DataFrame(out, columns=["region_id", "minx", "miny", "maxx", "maxy", "crs", "height", "width", "pixel_x", "pixel_y", "path"])

    return files.select("stem", "path").mapInPandas(run, "region_id string, minx double, miny double, maxx double, maxy double, crs string, height int, width int, pixel_x double, pixel_y double, path string")
