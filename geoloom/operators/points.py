"""Point clouds to grids: extents, surface (highest return) and terrain (lowest ground return)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOISE, GROUND = (7, 18), 2


def product_filter(product: str, excluded: tuple[int, ...] = NOISE) -> Column:
    """Surfaces take all classes but the excluded; terrain takes ground alone."""
    if product not in ("dsm", "dtm"):
        raise ValueError(f"no product {product!r}")
    keep = F.col("classification") == GROUND if product == "dtm" else ~F.col("classification").isin(*excluded) if excluded else F.lit(True)
    return keep & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()


def extents(points: DataFrame, resolution: float, product: str = "dsm", excluded: tuple[int, ...] = NOISE) -> DataFrame:
    """Per file: origin, width and height of its grid, a cell at least. Files without points of the product are absent."""
    found = points.where(product_filter(product, excluded)).groupBy("file_id").agg(F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"), F.count("*").alias("points"))
    cells = lambda low, high: F.greatest(F.lit(1).cast("long"), F.ceil((F.col(high) - F.col(low)) / resolution))
    return found.withColumn("width", cells("minx", "maxx")).withColumn("height", cells("miny", "maxy"))


def grid(points: DataFrame, resolution: float, product: str = "dsm", excluded: tuple[int, ...] = NOISE) -> DataFrame:
    """(file_id, row, col, value): float32 maximum of z per cell for dsm, minimum for dtm."""
    kept = points.where(product_filter(product, excluded)).select("file_id", "x", "y", "z")
    sized = kept.join(extents(points, resolution, product, excluded).select("file_id", "minx", "maxy", "width", "height"), "file_id")
    cell = lambda v, last: F.least(F.greatest((v / resolution).cast("long"), F.lit(0).cast("long")), F.col(last) - 1)
    placed = sized.select("file_id", cell(F.col("maxy") - F.col("y"), "height").alias("row"), cell(F.col("x") - F.col("minx"), "width").alias("col"), F.col("z").cast("float").alias("z"))
    return placed.groupBy("file_id", "row", "col").agg((F.max if product == "dsm" else F.min)("z").alias("value"))
