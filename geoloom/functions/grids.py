"""Tile grids as column expressions: XYZ, one-degree cells, systematic map sheets and projected grids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Mercator limits and the tables of the systematic sheet code.
MERCATOR_LAT = 85.05112878
HALF_WORLD = 20037508.342789244
SHEET_LEVELS = (  # columns and rows of a cell at a level, in 1:5,000 sheets, and the codes by row
    (96, 96, (("V", "X"), ("Y", "Z"))),
    (48, 48, (("A", "B"), ("C", "D"))),
    (16, 24, (("I", "II", "III"), ("IV", "V", "VI"))),
    (8, 12, (("1", "2"), ("3", "4"))),
    (4, 6, (("NO", "NE"), ("SO", "SE"))),
    (2, 2, (("A", "B"), ("C", "D"), ("E", "F"))),
    (1, 1, (("I", "II"), ("III", "IV"))),
)
SHEET_LON, SHEET_LAT = 6.0 / 192, 4.0 / 192


def _clip(value: Column, last: int) -> Column:
    return F.least(F.greatest(value, F.lit(0)), F.lit(last))


def xyz_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """(x, y) of the tile that holds a point, clipped to the grid; latitudes beyond Mercator's are clipped first."""
    n = 1 << zoom
    phi = F.radians(F.least(F.greatest(lat, F.lit(-MERCATOR_LAT)), F.lit(MERCATOR_LAT)))
    x = ((lon + 180.0) / 360.0 * n).cast("long")
    y = ((1.0 - F.ln(F.tan(phi) + 1.0 / F.cos(phi)) / math.pi) / 2.0 * n).cast("long")
    return _clip(x, n - 1), _clip(y, n - 1)


def xyz_cover(boxes: DataFrame, zoom: int, nudge: float = 1e-12) -> DataFrame:
    """A row (tile_x, tile_y) for each tile that a box in degrees touches; its upper edges are half-open."""
    west, north = xyz_tile(F.col("minx") + nudge, F.col("maxy") - nudge, zoom)
    east, south = xyz_tile(F.col("maxx") - nudge, F.col("miny") + nudge, zoom)
    rows = boxes.withColumn("tile_x", F.explode(F.sequence(west, east)))
    return rows.withColumn("tile_y", F.explode(F.sequence(north, south)))


def xyz_bounds(zoom: int, x: Column, y: Column) -> list[Column]:
    """west, south, east, north of a tile in degrees."""
    n = float(1 << zoom)
    lat = lambda row: F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * row / n))))
    return [x / n * 360.0 - 180.0, lat(y + 1), (x + 1) / n * 360.0 - 180.0, lat(y)]


def xyz_mercator_bounds(zoom: int, x: Column, y: Column) -> list[Column]:
    size = 2.0 * HALF_WORLD / (1 << zoom)
    return [x * size - HALF_WORLD, F.lit(HALF_WORLD) - (y + 1) * size, (x + 1) * size - HALF_WORLD, F.lit(HALF_WORLD) - y * size]


def tile_name_parts(name: Column) -> list[Column]:
    """zoom, x and y of names with z1_x2_y3 in them."""
    return [F.regexp_extract(name, r"z(\d+)_x(\d+)_y(\d+)", k).try_cast("int") for k in (1, 2, 3)]


def degree_cells(boxes: DataFrame, arc: str = "10") -> DataFrame:
    """A row for each one-degree cell of a box, half-open, with the name of its elevation tile."""
    cells = boxes.withColumn("lat", F.explode(F.sequence(F.floor("miny"), F.ceil("maxy") - 1))).withColumn("lon", F.explode(F.sequence(F.floor("minx"), F.ceil("maxx") - 1)))
    side = lambda v, plus, minus, width: F.concat(F.when(v >= 0, plus).otherwise(minus), F.lpad(F.abs(v).cast("string"), width, "0"))
    name = F.concat(F.lit(f"Copernicus_DSM_{arc}_"), side(F.col("lat"), "N", "S", 2), F.lit("_00_"), side(F.col("lon"), "E", "W", 3), F.lit("_00_DEM"))
    return cells.withColumn("tile", name)


def sheet_code(lon: Column, lat: Column) -> Column:
    """The code of the 1:5,000 sheet that holds a point south of the equator: a mixed-radix number, level by level."""
    column, row = F.floor((lon + 180.0) / SHEET_LON), F.floor(-lat / SHEET_LAT)
    parts = [F.concat(F.lit("S"), F.char(F.floor(row / 192) + 65)), F.lpad((F.floor(column / 192) + 1).cast("string"), 2, "0")]
    x, y = column % 192, row % 192
    for width, height, codes in SHEET_LEVELS:
        flat = F.array(*(F.lit(c) for line in codes for c in line))
        parts.append(F.element_at(flat, (F.floor(y / height) * len(codes[0]) + F.floor(x / width) + 1).cast("int")))
        x, y = x % width, y % height
    valid = (lon >= -180) & (lon < 180) & (lat > -88) & (lat < 0)
    return F.when(valid, F.concat_ws("-", *parts))


def sheet_cover(boxes: DataFrame, least_fraction: float = 0.0) -> DataFrame:
    """A row for each sheet that shares area with a box; a fraction is of the smaller of both areas."""
    rows = boxes.withColumn("sheet_row", F.explode(F.sequence(F.floor(-F.col("maxy") / SHEET_LAT), F.ceil(-F.col("miny") / SHEET_LAT) - 1)))
    rows = rows.withColumn("sheet_column", F.explode(F.sequence(F.floor((F.col("minx") + 180.0) / SHEET_LON), F.ceil((F.col("maxx") + 180.0) / SHEET_LON) - 1)))
    west, north = F.col("sheet_column") * SHEET_LON - 180.0, -F.col("sheet_row") * SHEET_LAT
    wide = F.least("maxx", west + SHEET_LON) - F.greatest("minx", west)
    high = F.least("maxy", north) - F.greatest("miny", north - SHEET_LAT)
    smaller = F.least((F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny")), F.lit(SHEET_LON * SHEET_LAT))
    rows = rows.where((wide > 0) & (high > 0) & (wide * high >= least_fraction * smaller))
    return rows.withColumn("code", sheet_code(west + SHEET_LON / 2, north - SHEET_LAT / 2))


def projected_box(axis: str) -> tuple[Column, Column]:
    """Bounds along an axis from the columns <axis> and <axis>_scale, _offset, _origin, _ceil, _floor, _round, _anchor, _size, _padding.

    At most one of the three steps is positive: it rounds the distance from the origin, where a value within 1e-9 of a step counts as on it.
    """
    c = lambda name: F.col(f"{axis}_{name}")
    at = F.col(axis) * c("scale") + c("offset") - c("origin")
    step = F.greatest(c("ceil"), c("floor"), c("round"))
    ratio = at / step
    near = F.rint(ratio)
    whole = F.when((c("round") > 0) | (F.abs(ratio - near) <= 1e-9), near).when(c("ceil") > 0, F.ceil(ratio).cast("double")).otherwise(F.floor(ratio).cast("double"))
    corner = F.when(step > 0, whole * step).otherwise(at) + c("origin")
    low = corner - F.when(c("anchor") == "min", 0.0).when(c("anchor") == "max", c("size")).otherwise(c("size") / 2.0) - c("padding")
    return low, low + c("size") + 2 * c("padding")


def utm_tile(name: Column, north: bool = True, grid: int = 10000) -> list[Column]:
    """epsg, x and y of the lower left corner of names like x25y422 after a zone."""
    part = lambda k: F.regexp_extract(name, r"(?i)_(\d{1,2})_x(\d+)y(\d+)", k).try_cast("int")
    return [part(1) + (32600 if north else 32700), part(2) * grid, (part(3) - 1) * grid]
