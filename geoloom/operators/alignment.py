"""Rasters on the grid of a target, and windows of native cells about points.

A grid is an affine transform (a, b, c, d, e, f), as x = a * col + b * row + c and y = d * col + e * row + f, with a
width, a height and the code of a coordinate system. Cells are (raster_id, row, col, value) with null for no value.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import crs
from geoloom.operators import boxes, rasters

AFFINE = ("a", "b", "c", "d", "e", "f")
GRID = (*AFFINE, "width", "height", "crs")


def forward(prefix: str, col: Column, row: Column) -> tuple[Column, Column]:
    """Place of a fractional cell."""
    g = {k: F.col(prefix + k) for k in AFFINE}
    return g["a"] * col + g["b"] * row + g["c"], g["d"] * col + g["e"] * row + g["f"]


def backward(prefix: str, x: Column, y: Column) -> tuple[Column, Column]:
    """Fractional column and row of a place."""
    g = {k: F.col(prefix + k) for k in AFFINE}
    det = g["a"] * g["e"] - g["b"] * g["d"]
    dx, dy = x - g["c"], y - g["f"]
    return (g["e"] * dx - g["b"] * dy) / det, (g["a"] * dy - g["d"] * dx) / det


def bounds(prefix: str) -> list[Column]:
    """minx, miny, maxx, maxy of a grid."""
    corners = [forward(prefix, c, r) for c in (F.lit(0.0), F.col(f"{prefix}width")) for r in (F.lit(0.0), F.col(f"{prefix}height"))]
    return [F.least(*(p[0] for p in corners)), F.least(*(p[1] for p in corners)), F.greatest(*(p[0] for p in corners)), F.greatest(*(p[1] for p in corners))]


def target_grid(targets: DataFrame, scale: int = 1) -> DataFrame:
    """Targets on a grid that is scale times coarser; a side that is no multiple of scale is an error."""
    fits = (F.col("width") % scale == 0) & (F.col("height") % scale == 0)
    checked = F.when(fits, F.col("width") / scale).otherwise(F.raise_error(F.format_string("a target of %d by %d cells has no grid of %d", "width", "height", F.lit(scale))))
    return targets.select(*(c for c in targets.columns if c not in (*AFFINE[:2], "d", "e", "width", "height")), *((F.col(k) * scale).alias(k) for k in "abde"), checked.cast("long").alias("width"), (F.col("height") / scale).cast("long").alias("height"))


def native_grid(pairs: DataFrame) -> DataFrame:
    """The grid of the source's own cells that covers a region: from (minx, miny, maxx, maxy) in the source's system and s_ grids,
    row0, col0, out_height, out_width and the transform o_c, o_f of the first cell; cells may lie outside of the source."""
    corners = [backward("s_", F.col(x), F.col(y)) for x in ("minx", "maxx") for y in ("miny", "maxy")]
    low, high = (lambda k: F.least(*(p[k] for p in corners))), (lambda k: F.greatest(*(p[k] for p in corners)))
    framed = pairs.withColumn("col0", F.floor(low(0))).withColumn("row0", F.floor(low(1))).withColumn("out_width", F.ceil(high(0)) - F.col("col0")).withColumn("out_height", F.ceil(high(1)) - F.col("row0"))
    x, y = forward("s_", F.col("col0"), F.col("row0"))
    return framed.withColumn("o_c", x).withColumn("o_f", y)


def clipped_window(prefix: str = "t_") -> list[Column]:
    """col0, row0, col1, row1 of the cells of a grid that a box (minx, miny, maxx, maxy) touches; empty where low is not below high."""
    corners = [backward(prefix, F.col(x), F.col(y)) for x in ("minx", "maxx") for y in ("miny", "maxy")]
    out = []
    for pick, edge in ((F.least, F.floor), (F.greatest, F.ceil)):
        for k, side in ((0, "width"), (1, "height")):
            v = edge(pick(*(p[k] for p in corners))).cast("long")
            out.append(F.greatest(v, F.lit(0).cast("long")) if pick is F.least else F.least(v, F.col(prefix + side).cast("long")))
    return out


def with_envelope(rows: DataFrame, source: str, target: str) -> DataFrame:
    """Rows with minx to maxy carried from the system in one column to that in another, by densified edges; equal systems stay."""
    same = rows.where(F.col(source) == F.col(target))
    sides = list(boxes.SIDES)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (a, b), own in frame.groupby([source, target]):
                out = crs.envelopes(*(own[s].to_numpy(float) for s in sides), a, b)
                if not np.isfinite(out).all():
                    raise ValueError(f"bounds in {a} have no finite image in {b}")
                yield own.assign(**dict(zip(sides, out, strict=True)))

    other = rows.where(F.col(source) != F.col(target))
    return same.unionByName(other.mapInPandas(run, rows.schema))


def with_place(rows: DataFrame, source: str, target: str, x: str = "x", y: str = "y") -> DataFrame:
    """Rows with points carried from the system in one column to that in another."""
    same = rows.where(F.col(source) == F.col(target))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (a, b), own in frame.groupby([source, target]):
                px, py = crs.transform(own[x].to_numpy(float), own[y].to_numpy(float), a, b)
                yield own.assign(**{x: px, y: py})

    return same.unionByName(rows.where(F.col(source) != F.col(target)).mapInPandas(run, rows.schema))


def pair_grids(targets: DataFrame, sources: DataFrame, size: float) -> DataFrame:
    """Targets (region_id and grid) with sources (raster_id, path, bands and grid) of the region, as t_ and s_ columns, with the box that the
    source covers in the target's system. sources name their region_id; a source with other bands than the first is an error."""
    t = targets.select("region_id", *(F.col(k).alias(f"t_{k}") for k in GRID))
    s = sources.select("region_id", "raster_id", "path", "bands", *(F.col(k).alias(f"s_{k}") for k in GRID))
    joined = t.join(s, "region_id")
    first = joined.groupBy("region_id").agg(F.min_by("bands", "path").alias("_bands"))
    checked = joined.join(first, "region_id").withColumn("bands", F.when(F.col("bands") == F.col("_bands"), F.col("bands")).otherwise(F.raise_error(F.concat(F.lit("another number of bands in "), "path")))).drop("_bands")
    named = checked.withColumn("s_crs", F.coalesce("s_crs", F.raise_error(F.concat(F.lit("no coordinate system in "), "path")).cast("string")))
    boxed = named.select("*", *(c.alias(n) for c, n in zip(bounds("s_"), boxes.SIDES, strict=True)))
    return with_envelope(boxed, "s_crs", "t_crs")


def align(pairs: DataFrame, cells: DataFrame, method: str = "bilinear", merge: str = "first") -> DataFrame:
    """(region_id, row, col, value) of targets, from pair_grids' rows and the sources' cells.

    Only cells of a target below a source are made. Point methods look the cell's centre up in the source; the others
    gather the source's cells whose centres lie in the target's cell. Weights are renormalised over valid cells. Of sources
    that have a value the first or last by path wins.
    """
    if merge not in ("first", "last"):
        raise ValueError(f"no merge method {merge!r}")
    key = F.struct("region_id", "raster_id").alias("raster_id")
    paths = pairs.select(key, "path")
    if method == "nearest" or method in rasters.KERNELS:
        col0, row0, col1, row1 = clipped_window("t_")
        cut = pairs.withColumn("_r", F.when((row0 < row1) & (col0 < col1), F.sequence(row0, row1 - 1))).withColumn("_c", F.sequence(col0, F.greatest(col1 - 1, col0)))
        spread = cut.withColumn("row", F.explode("_r")).withColumn("col", F.explode("_c"))
        x, y = forward("t_", F.col("col") + 0.5, F.col("row") + 0.5)
        placed = with_place(spread.select("region_id", "raster_id", *(f"s_{k}" for k in GRID), "t_crs", "row", "col", x.alias("x"), y.alias("y")), "t_crs", "s_crs")
        at_col, at_row = backward("s_", F.col("x"), F.col("y"))
        inside = (F.col("at_row") >= 0) & (F.col("at_col") >= 0) & (F.col("at_row") < F.col("s_height")) & (F.col("at_col") < F.col("s_width"))
        asked = placed.withColumn("at_col", at_col).withColumn("at_row", at_row).where(inside)
        if method == "nearest":
            source = cells.where("value is not null").select("raster_id", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
            found = asked.withColumn("_r", F.floor("at_row").cast(cells.schema["row"].dataType)).withColumn("_c", F.floor("at_col").cast(cells.schema["col"].dataType)).join(source, ["raster_id", "_r", "_c"]).select(key, "row", "col", "value")
        else:
            found = _by_kernel(asked, cells, method)
    else:
        placed = cells.where("value is not null").join(pairs, "raster_id").select("region_id", "raster_id", *(f"t_{k}" for k in GRID), "s_crs", "value", *(c.alias(n) for c, n in zip(forward("s_", F.col("col") + 0.5, F.col("row") + 0.5), "xy", strict=True)))
        at_col, at_row = backward("t_", F.col("x"), F.col("y"))
        there = with_place(placed, "s_crs", "t_crs").withColumn("col", F.floor(at_col).cast("long")).withColumn("row", F.floor(at_row).cast("long"))
        there = there.where("row >= 0 and col >= 0 and row < t_height and col < t_width")
        found = rasters.reduce_by(there.select(key, "row", "col", "value"), 1, method)
    pick = F.min_by if merge == "first" else F.max_by
    return found.join(paths, "raster_id").groupBy("raster_id.region_id", "row", "col").agg(pick("value", "path").alias("value"))


def _by_kernel(asked: DataFrame, cells: DataFrame, method: str) -> DataFrame:
    reach = rasters.KERNELS[method]
    near = F.sequence(F.lit(1 - reach), F.lit(reach))
    low_r, low_c = F.floor(F.col("at_row") - 0.5), F.floor(F.col("at_col") - 0.5)
    spread = asked.withColumn("_dr", F.explode(near)).withColumn("_dc", F.explode(near)).withColumn("_r", low_r + F.col("_dr")).withColumn("_c", low_c + F.col("_dc"))
    source = cells.where("value is not null").select("raster_id", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    weight = rasters.kernel_weight(method, F.col("at_row") - 0.5 - F.col("_r")) * rasters.kernel_weight(method, F.col("at_col") - 0.5 - F.col("_c"))
    found = spread.join(source, ["raster_id", "_r", "_c"]).withColumn("_w", weight)
    out = found.groupBy(F.struct("region_id", "raster_id").alias("raster_id"), "row", "col").agg(F.sum(F.col("_w") * F.col("value")).alias("_v"), F.sum("_w").alias("_w"))
    return out.where("_w <> 0").select("raster_id", "row", "col", (F.col("_v") / F.col("_w")).alias("value"))


def native_crop(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """(region_id, raster_id, row, col, value): the source's own cells on native_grid's window of each pair."""
    return rasters.window_cells(cells, native_grid(pairs).select("region_id", "raster_id", F.col("row0").cast("long"), F.col("col0").cast("long"), F.col("out_height").alias("height"), F.col("out_width").alias("width")))


# Windows about points


def geodesic_length(lon1, lat1, lon2, lat2, inverse_f: float = 298.257223563):
    """Metres between points in degrees (Vincenty's inverse formula), as arrays."""
    f = 1 / inverse_f
    b = crs.A * (1 - f)
    u1, u2, big_l = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2))), np.radians(np.asarray(lon2) - lon1)
    lam = big_l
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(60):
            ss = np.hypot(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam))
            cs = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss > 0, np.cos(u1) * np.cos(u2) * np.sin(lam) / np.where(ss > 0, ss, 1), 0.0)
            ca2 = 1 - sa**2
            m = np.where(ca2 > 0, cs - 2 * np.sin(u1) * np.sin(u2) / np.where(ca2 > 0, ca2, 1), 0.0)
            c = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
            lam = big_l + (1 - c) * f * sa * (sigma + c * ss * (m + c * cs * (2 * m * m - 1)))
    k = ca2 * (crs.A**2 - b**2) / b**2
    big_a, big_b = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))), k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    delta = big_b * ss * (m + big_b / 4 * (cs * (2 * m * m - 1) - big_b / 6 * m * (4 * ss**2 - 3) * (4 * m * m - 3)))
    return b * big_a * (sigma - delta)


def with_pixel_size(rows: DataFrame, prefix: str = "s_") -> DataFrame:
    """Rows (x, y in the grid's system) with x_metres and y_metres, the size of a cell there: lengths for projected systems, geodesics for degrees."""
    schema = T.StructType([*rows.schema.fields, T.StructField("x_metres", T.DoubleType()), T.StructField("y_metres", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for code, own in frame.groupby(prefix + "crs"):
                s = crs.system(code)
                a, b, d, e = (own[prefix + k].to_numpy(float) for k in "abde")
                if s.method != "geographic":
                    yield own.assign(x_metres=np.hypot(a, d) * s.unit, y_metres=np.hypot(b, e) * s.unit)
                else:
                    x, y = own["x"].to_numpy(float), own["y"].to_numpy(float)
                    yield own.assign(x_metres=geodesic_length(x, y, x + a, y + d), y_metres=geodesic_length(x, y, x + b, y + e))

    return rows.mapInPandas(run, schema)


def anchors(points: DataFrame, sources: DataFrame, size: float) -> DataFrame:
    """For each point (point_id, x, y in the sources' system) the source around it whose nearest edge is farthest in cells, of equals the greatest
    path, as s_ columns. Points and rasters meet through cells of the given size."""
    boxed = sources.select("raster_id", "path", *(F.col(k).alias(f"s_{k}") for k in GRID))
    boxed = boxed.select("*", *(c.alias(f"r_{n}") for c, n in zip(bounds("s_"), boxes.SIDES, strict=True)))
    at = points.select(*(F.col(c) for c in points.columns), *(F.col(c).alias(f"l_{n}") for n, c in zip(boxes.SIDES, ("x", "y", "x", "y"), strict=True)))
    met = boxes.box_join(at, boxed, size, touch=True)
    col, row = backward("s_", F.col("x"), F.col("y"))
    margin = F.least(col, F.col("s_width") - col, row, F.col("s_height") - row)
    kept = [c for c in boxed.columns if not c.startswith("r_")]
    inside = met.withColumn("margin", margin).where("margin >= 0")
    best = inside.groupBy(*points.columns).agg(F.max_by(F.struct(*kept), F.struct("margin", "path")).alias("_best"))
    return best.select(*points.columns, "_best.*")


def point_windows(anchored: DataFrame, size_m: float) -> DataFrame:
    """Adds col0, row0, width, height and the place o_c, o_f of the first cell: a window of size_m about the point in whole native cells, rounded half to even."""
    sized = with_pixel_size(anchored)
    col, row = backward("s_", F.col("x"), F.col("y"))
    wide, high = (F.greatest(F.lit(1.0), F.rint(F.lit(size_m) / F.col(c))) for c in ("x_metres", "y_metres"))
    framed = sized.withColumn("width", wide.cast("long")).withColumn("height", high.cast("long")).withColumn("col0", F.rint(col - wide / 2).cast("long")).withColumn("row0", F.rint(row - high / 2).cast("long"))
    x, y = forward("s_", F.col("col0"), F.col("row0"))
    return framed.withColumn("o_c", x).withColumn("o_f", y)


def _like_grids(a: str, b: str) -> tuple[Column, Column]:
    """Whether two grids have one linear part, and by what share their cells' sides differ; null where they are turned against each other."""
    parts = [(F.col(a + k), F.col(b + k)) for k in "abde"]
    scale = F.greatest(F.lit(1.0), *(F.abs(v) for p in parts for v in p))
    same = F.lit(True)
    for p, q in parts:
        same = same & (F.abs(p - q) <= scale * 1e-9)
    shares = []
    turned = F.lit(False)
    for u, v in (("a", "d"), ("b", "e")):
        la, lb = F.hypot(a + u, a + v), F.hypot(b + u, b + v)
        turned = turned | (la <= 0) | (lb <= 0) | (F.abs(F.try_divide(F.col(a + u), la) - F.try_divide(F.col(b + u), lb)) > 1e-9) | (F.abs(F.try_divide(F.col(a + v), la) - F.try_divide(F.col(b + v), lb)) > 1e-9)
        shares.append(F.abs(F.try_divide(lb - la, la)))
    return same, F.when(~turned, F.greatest(*shares))


def fit_of_sources(windows: DataFrame, sources: DataFrame, max_snap: float = 0.0, max_mismatch: float | None = None) -> DataFrame:
    """Windows with each source of their region: how it fits (native, resampled, or why not), the shift to its cells, and the snap in cells.

    windows: point_windows' rows with region_id; sources: (region_id, raster_id, path and grid). The anchor comes first, the others by path.
    """
    own = sources.select("region_id", F.col("raster_id").alias("source_id"), F.col("path").alias("source_path"), *(F.col(k).alias(f"g_{k}") for k in GRID))
    met = windows.join(own, "region_id")
    same, share = _like_grids("s_", "g_")
    col, row = backward("g_", F.col("o_c"), F.col("o_f"))
    snapped = met.withColumn("shift_col", F.rint(col).cast("long")).withColumn("shift_row", F.rint(row).cast("long")).withColumn("snap", F.greatest(F.abs(col - F.rint(col)), F.abs(row - F.rint(row)))).withColumn("mismatch", share)
    fit = F.when(~F.col("s_crs").eqNullSafe(F.col("g_crs")), "CRS").when(same & (F.col("snap") <= max_snap + 1e-9), "native").when(same, "grid origin")
    if max_mismatch is not None:
        fit = fit.when(F.col("mismatch") <= max_mismatch + 1e-12, "resampled")
    order = F.struct((F.col("source_path") != F.col("path")).alias("other"), F.col("source_path"))
    return snapped.withColumn("fit", fit.otherwise("resolution/rotation")).withColumn("order", order)


def native_mosaic(fitted: DataFrame, cells: DataFrame) -> DataFrame:
    """(point_id, row, col, value, source_path): cells of native sources, copied; the first source in order that has a value wins."""
    windows = fitted.where("fit = 'native'").select("point_id", F.col("source_id").alias("raster_id"), "source_path", "order", F.col("shift_row").alias("row0"), F.col("shift_col").alias("col0"), "height", "width")
    got = rasters.window_cells(cells.where("value is not null"), windows)
    return got.groupBy("point_id", "row", "col").agg(F.min_by(F.struct("value", "source_path"), "order").alias("_v")).select("point_id", "row", "col", "_v.*")


def seam_fill(fitted: DataFrame, native: DataFrame, cells: DataFrame, least: float = 1.0, cap: float = 0.25) -> DataFrame:
    """native with cells that are still empty filled by bilinear values of the sources that need resampling, in order.

    A source whose new cells would lift the filled share over cap is skipped; filling ends once the valid share is enough. As each step
    depends on those before, a window is folded in one task: its cells are as many as the window's, whatever the rasters' size.
    """
    wanted = fitted.where("fit = 'resampled'")
    col, row = backward("g_", F.col("x"), F.col("y"))
    spread = wanted.withColumn("row", F.explode(F.expr("sequence(0L, height - 1)"))).withColumn("col", F.explode(F.expr("sequence(0L, width - 1)")))
    x, y = (F.col(f"s_{p}") * (F.col("col0") + F.col("col") + 0.5) + F.col(f"s_{q}") * (F.col("row0") + F.col("row") + 0.5) + F.col(f"s_{r}") for p, q, r in (("a", "b", "c"), ("d", "e", "f")))
    asked = spread.withColumn("x", x).withColumn("y", y).withColumn("at_col", col).withColumn("at_row", row)
    asked = asked.where("at_row >= 0 and at_col >= 0 and at_row < g_height and at_col < g_width")
    offers = _by_kernel(asked.select(F.col("point_id").alias("region_id"), F.col("source_id").alias("raster_id"), "row", "col", "at_row", "at_col"), cells, "bilinear")
    offers = offers.select(F.col("raster_id.region_id").alias("point_id"), F.col("raster_id.raster_id").alias("source_id"), "row", "col", "value")
    offers = offers.join(wanted.select("point_id", "source_id", "source_path"), ["point_id", "source_id"])
    windows = fitted.groupBy("point_id").agg(F.first("height").alias("height"), F.first("width").alias("width"))
    both = native.select("point_id", "row", "col", "value", "source_path", F.lit(False).alias("resampled")).unionByName(offers.select("point_id", "row", "col", "value", "source_path", F.lit(True).alias("resampled")))
    rows = both.join(windows, "point_id").withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long"))

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        height, width = int(frame["height"].iloc[0]), int(frame["width"].iloc[0])
        total, kept = height * width, frame[~frame["resampled"]]
        have = np.zeros((height, width), bool)
        have[kept["row"], kept["col"]] = True
        out, filled = [kept], 0
        for _, offer in frame[frame["resampled"]].groupby("source_path", sort=True):
            if have.sum() / total + 1e-12 >= least:
                break
            new = offer[~have[offer["row"], offer["col"]]]
            if len(new) and filled + len(new) <= cap * total + 1e-9:
                have[new["row"], new["col"]] = True
                filled += len(new)
                out.append(new)
        return pd.concat(out)[["point_id", "row", "col", "value", "source_path", "resampled"]]

    kind = native.schema["point_id"].dataType.simpleString()
    return rows.groupBy("point_id").applyInPandas(fold, f"point_id {kind}, row long, col long, value double, source_path string, resampled boolean")


def window_report(fitted: DataFrame, filled: DataFrame, least: float = 1.0) -> DataFrame:
    """Per point: cells, valid and resampled cells and their shares, the sources used, and whether enough is valid."""
    windows = fitted.groupBy("point_id").agg((F.first("height") * F.first("width")).alias("total"), F.count(F.lit(1)).alias("sources"), F.array_sort(F.collect_list(F.when(~F.col("fit").isin("native", "resampled"), F.concat_ws(": ", "source_path", "fit")))).alias("incompatible"))
    got = filled.groupBy("point_id").agg(F.count(F.lit(1)).alias("n_valid"), F.count_if("resampled").alias("n_resampled"), F.array_sort(F.collect_set(F.when(F.col("resampled"), F.col("source_path")))).alias("resampled_sources"))
    out = windows.join(got, "point_id", "left").na.fill(0, ["n_valid", "n_resampled"])
    share = F.col("n_valid") / F.col("total")
    return out.select("point_id", "total", "sources", "n_valid", "n_resampled", share.alias("valid_fraction"), (F.col("n_resampled") / F.col("total")).alias("resampled_fraction"), F.coalesce("resampled_sources", F.array().cast("array<string>")).alias("resampled_sources"), "incompatible", (share + 1e-12 >= least).alias("enough"), F.when(F.col("n_resampled") > 0, "partial_bilinear").otherwise("none").alias("resampling"))


def vertical_mismatches(pairs: DataFrame, shown: int = 3) -> DataFrame:
    """One row if height systems of sources and targets differ, none if not: the first regions by name, how many more, and the message; heights are never converted.

    pairs: (region_id, source_vertical, target_vertical), null for unknown, one source a region."""
    said = F.format_string("region=%s source=%s target=%s", "region_id", F.coalesce("source_vertical", F.lit("unknown")), F.coalesce("target_vertical", F.lit("unknown")))
    differ = pairs.where(~F.col("source_vertical").eqNullSafe(F.col("target_vertical"))).select("region_id", said.alias("said"))
    first = differ.orderBy("region_id").limit(shown).agg(F.array_sort(F.collect_list(F.struct("region_id", "said"))).alias("first"))
    counted = differ.agg(F.count(F.lit(1)).alias("n"))
    more = F.when(F.col("n") > shown, F.format_string("; plus %d more regions", F.col("n") - shown)).otherwise("")
    return counted.crossJoin(first).where("n > 0").select("n", F.concat(F.array_join(F.transform("first", lambda s: s["said"]), "; "), more).alias("message"))  # one row on either side


