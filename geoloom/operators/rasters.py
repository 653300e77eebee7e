"""Grid algebra over cells (raster_id, row, col, value), where a null value is invalid."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REDUCERS = ("nearest", "average", "min", "max", "med", "q1", "q3", "sum", "rms", "mode")
KERNELS = {"bilinear": 1, "cubic": 2, "cubic_spline": 2, "lanczos": 3}
#: Cells along a side of the blocks by which cells and windows meet.
BLOCK = 64


def valid(value: Column, nodata: float | None = None) -> Column:
    """The value, or null where it is missing, not a number or the marker of no data."""
    bad = F.isnan(value) | (F.lit(False) if nodata is None else value == nodata)
    return F.when(~bad, value)


def mosaic(cells: DataFrame, rank: str, method: str = "first") -> DataFrame:
    """Per cell the valid value of the first or last raster by rank."""
    if method not in ("first", "last"):
        raise ValueError(f"no merge method {method!r}")
    pick = F.min_by if method == "first" else F.max_by
    return cells.where("value is not null").groupBy("row", "col").agg(pick("value", rank).alias("value"))


def reduce_by(cells: DataFrame, factor: int, method: str) -> DataFrame:
    """Cells of a grid that is factor times coarser, from the valid cells below each; aligned at (0, 0)."""
    row, col = F.floor(F.col("row") / factor), F.floor(F.col("col") / factor)
    v = F.col("value")
    keyed = cells.where(v.isNotNull()).select("raster_id", row.alias("row"), col.alias("col"), v.alias("value"), (F.col("row") % factor).alias("_r"), (F.col("col") % factor).alias("_c"))
    if method == "nearest":
        return keyed.where((F.col("_r") == factor // 2) & (F.col("_c") == factor // 2)).select("raster_id", "row", "col", "value")
    how = {
        "average": F.avg("value"), "min": F.min("value"), "max": F.max("value"), "med": F.percentile("value", 0.5), "q1": F.percentile("value", 0.25), "q3": F.percentile("value", 0.75),
        "sum": F.sum("value"), "rms": F.sqrt(F.avg(F.col("value") * F.col("value"))),
    }
    if method == "mode":  # the most frequent value, of equals the least
        counted = keyed.groupBy("raster_id", "row", "col", "value").agg(F.count("*").alias("_n"))
        return counted.groupBy("raster_id", "row", "col").agg(F.min_by("value", F.struct(-F.col("_n"), F.col("value"))).alias("value"))
    return keyed.groupBy("raster_id", "row", "col").agg(how[method].alias("value"))


def kernel_weight(method: str, t: Column) -> Column:
    a = F.abs(t)
    if method == "bilinear":
        return F.greatest(1 - a, F.lit(0.0))
    if method == "cubic":
        return F.when(a <= 1, 1.5 * a**3 - 2.5 * a**2 + 1).when(a < 2, -0.5 * a**3 + 2.5 * a**2 - 4 * a + 2).otherwise(0.0)
    if method == "cubic_spline":
        return F.when(a <= 1, (4 - 6 * a**2 + 3 * a**3) / 6).when(a < 2, (2 - a) ** 3 / 6).otherwise(0.0)
    x = math.pi * a
    return F.when(a == 0, 1.0).when(a < 3, 3 * F.sin(x) * F.sin(x / 3) / (x * x)).otherwise(0.0)


def resample(targets: DataFrame, cells: DataFrame, method: str = "bilinear") -> DataFrame:
    """Values at fractional source places, weights renormalised over valid cells. targets: (raster_id, row, col, at_row, at_col)."""
    reach = KERNELS[method]
    near = F.sequence(F.lit(1 - reach), F.lit(reach))
    spread = targets.withColumn("_dr", F.explode(near)).withColumn("_dc", F.explode(near))
    low_r, low_c = F.floor(F.col("at_row") - 0.5), F.floor(F.col("at_col") - 0.5)
    spread = spread.select("raster_id", "row", "col", "at_row", "at_col", (low_r + F.col("_dr")).alias("_r"), (low_c + F.col("_dc")).alias("_c"))
    source = cells.where("value is not null").select("raster_id", F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    weight = kernel_weight(method, F.col("at_row") - 0.5 - F.col("_r")) * kernel_weight(method, F.col("at_col") - 0.5 - F.col("_c"))
    found = spread.join(source, ["raster_id", "_r", "_c"]).withColumn("_w", weight)
    out = found.groupBy("raster_id", "row", "col").agg(F.sum(F.col("_w") * F.col("value")).alias("_v"), F.sum("_w").alias("_w"))
    return out.where("_w <> 0").select("raster_id", "row", "col", (F.col("_v") / F.col("_w")).alias("value"))


def void_fill(upper: DataFrame, base: DataFrame) -> DataFrame:
    """The upper raster's valid values, else the base's, on equal grids."""
    b = base.select("raster_id", "row", "col", F.col("value").alias("base"))
    out = upper.join(b, ["raster_id", "row", "col"])
    return out.select("raster_id", "row", "col", F.coalesce("value", "base").alias("value"), (F.col("value").isNull() & F.col("base").isNotNull()).alias("filled"))


def fill_stats(filled: DataFrame) -> DataFrame:
    """Per raster: cells, filled and unfilled cells, and the share filled."""
    out = filled.groupBy("raster_id").agg(F.count("*").alias("total"), F.count_if("filled").alias("n_filled"), F.count_if(F.col("value").isNull()).alias("unfilled"))
    return out.withColumn("share", F.col("n_filled") / F.col("total"))


def fill_summary(filled: DataFrame, group: str) -> DataFrame:
    """Per group of rasters: the mean of their shares filled, each raster counting once, and the share of all their cells."""
    each = filled.groupBy(group, "raster_id").agg(F.count("*").alias("total"), F.count_if("filled").alias("n_filled"))
    return each.groupBy(group).agg(F.count("*").alias("rasters"), F.avg(F.col("n_filled") / F.col("total")).alias("mean_share"), (F.sum("n_filled") / F.sum("total")).alias("overall_share"))


def point_window(origin: float, resolution: Column, size: float, at: Column) -> tuple[Column, Column]:
    """First cell and cells of a window of size about a point along an axis; both rounded half to even, one cell at least."""
    width = F.greatest(F.lit(1.0), F.rint(F.lit(size) / resolution))
    return F.rint((at - origin) / resolution - width / 2).cast("int"), width.cast("int")


def window_cells(cells: DataFrame, windows: DataFrame) -> DataFrame:
    """Cells of windows (raster_id, row0, col0, height, width and other columns) by their place in the window. Both sides meet by blocks of
    BLOCK cells, so a window meets the cells near it and not all of its raster."""
    block = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / BLOCK), F.floor((F.col(low) + F.col(high) - 1) / BLOCK)))
    spread = windows.where("height > 0 and width > 0").withColumn("_br", block("row0", "height")).withColumn("_bc", block("col0", "width"))
    keyed = cells.withColumn("_br", F.floor(F.col("row") / BLOCK)).withColumn("_bc", F.floor(F.col("col") / BLOCK))
    joined = keyed.join(spread, ["raster_id", "_br", "_bc"])
    row, col = F.col("row") - F.col("row0"), F.col("col") - F.col("col0")
    inside = (row >= 0) & (col >= 0) & (row < F.col("height")) & (col < F.col("width"))
    rest = [c for c in windows.columns if c not in ("row0", "col0", "height", "width")]
    return joined.where(inside).select(*rest, row.alias("row"), col.alias("col"), "value")


def valid_fraction(cells: DataFrame, windows: DataFrame, least: float = 1.0) -> DataFrame:
    """Per window the share of its cells that are valid, and whether that is enough."""
    n = cells.groupBy("window_id").agg(F.count("value").alias("n_valid"))
    out = windows.join(n, "window_id", "left")
    share = F.coalesce("n_valid", F.lit(0)) / (F.col("height") * F.col("width"))
    return out.select("window_id", share.alias("fraction"), (share >= least - 1e-12).alias("enough"))


def capped_fill(offers: DataFrame, least: float, cap: float) -> DataFrame:
    """Which sources fill a window, in order: one that would lift the resampled share over cap is skipped, and filling
    ends once the share of valid cells is enough. offers: (window_id, rank, cells array<int>, native array<int>, total).

    Depends on the order and on what was taken before, so each window is folded in one task; a window's cells are bounded.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        have, resampled, total = set(pdf["native"].iloc[0]), 0, int(pdf["total"].iloc[0])
        out = []
        for rank, cells in zip(pdf["rank"], pdf["cells"], strict=True):
            if len(have) / total >= least - 1e-12:
                break
            new = set(cells) - have
            if new and (resampled + len(new)) / total <= cap + 1e-12:
                have |= new
                resampled += len(new)
                out.append((pdf["window_id"].iloc[0], rank, len(new)))
        return pd.DataFrame(out, columns=["window_id", "rank", "taken"])

    return offers.groupBy("window_id").applyInPandas(fold, "window_id long, rank int, taken long")


def windows_of(width: int, height: int, size: int = 1024) -> Iterator[tuple[int, int, int, int]]:
    """(row, col, height, width) of the blocks of a grid."""
    for row in range(0, height, size):
        for col in range(0, width, size):
            yield row, col, min(size, height - row), min(size, width - col)


def same_grid(a: tuple[float, ...], b: tuple[float, ...]) -> bool:
    """Whether two affine transforms (a, b, c, d, e, f) have equal linear parts within 1e-9 of their size."""
    return all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9 * max(map(abs, a[:2] + a[3:5]))) for x, y in zip(a[:2] + a[3:5], b[:2] + b[3:5], strict=True))


def mismatch(a: tuple[float, ...], b: tuple[float, ...]) -> float:
    """Relative difference of pixel sizes; infinite if the orientation differs."""
    size = lambda t: (math.hypot(t[0], t[3]), math.hypot(t[1], t[4]))
    (ax, ay), (bx, by) = size(a), size(b)
    turned = any(abs(p / s - q / r) > 1e-9 for p, q, s, r in ((a[0], b[0], ax, bx), (a[3], b[3], ax, bx), (a[1], b[1], ay, by), (a[4], b[4], ay, by)))
    return math.inf if turned else max(abs(bx / ax - 1), abs(by / ay - 1))
