"""Joins of axis-parallel boxes through cells, and coverage by ranked boxes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import polygons

SIDES = ("minx", "miny", "maxx", "maxy")
#: Tiles of a region, or of a part of one, that are swept together.
DENSE = 1000
#: Tasks of a join by cells for each shuffle partition, as cells differ.
TASKS = 4
#: Rows with the same box that are kept in one array.
BUNDLE = 1000


def overlap(a: str, b: str, touch: bool = False) -> Column:
    """Whether two boxes share area; with touch, also edges and corners."""
    less = (lambda x, y: F.col(x) <= F.col(y)) if touch else (lambda x, y: F.col(x) < F.col(y))
    return less(f"{a}minx", f"{b}maxx") & less(f"{b}minx", f"{a}maxx") & less(f"{a}miny", f"{b}maxy") & less(f"{b}miny", f"{a}maxy")


def _cells(frame: DataFrame, prefix: str, size: float) -> DataFrame:
    span = lambda low, high: F.explode(F.sequence(F.floor(F.col(prefix + low) / size), F.floor(F.col(prefix + high) / size)))
    return frame.withColumn("_cx", span("minx", "maxx")).withColumn("_cy", span("miny", "maxy"))


def _meet(left: DataFrame, right: DataFrame, size: float, touch: bool = False) -> DataFrame:
    """Pairs of rows whose boxes overlap, each in the one cell that holds the lower left corner of what both share."""
    # a fixed number of tasks, as the pairs of a small table can be many
    tasks = TASKS * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = [_cells(frame, prefix, size).repartition(tasks, "_cx", "_cy") for frame, prefix in ((left, "l_"), (right, "r_"))]
    joined = dealt[0].join(dealt[1], ["_cx", "_cy"]).where(overlap("l_", "r_", touch))
    own = (F.col("_cx") == F.floor(F.greatest("l_minx", "r_minx") / size)) & (F.col("_cy") == F.floor(F.greatest("l_miny", "r_miny") / size))
    return joined.where(own).drop("_cx", "_cy")


def _lots(frame: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows of equal keys as one, with what else they have in an array of at most BUNDLE."""
    rest = [F.col(c) for c in frame.columns if c not in keys] or [F.lit(0).alias(f"_{name}")]
    lot = F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) - 1) / BUNDLE)
    return frame.withColumn("_lot", lot).groupBy(*keys, "_lot").agg(F.collect_list(F.struct(*rest)).alias(name)).drop("_lot")


def box_join(left: DataFrame, right: DataFrame, size: float, touch: bool = False) -> DataFrame:
    """Pairs of boxes that overlap. Columns of left must start with l_, of right with r_, sides among them.

    Rows with the same box are compared as one and made into pairs once it is met. Both sides are dealt to cells of
    the given size and joined on the cell; a pair is kept in the one cell that holds the lower left corner of what
    both share, so no distinct is needed. Take a size near the larger boxes'.
    """
    met = _meet(*(_lots(frame, [p + s for s in SIDES], f"_{p}rows") for frame, p in ((left, "l_"), (right, "r_"))), size, touch)
    sides = [p + s for p in ("l_", "r_") for s in SIDES]
    # transform is interpreted and so parts the compiled loops: a loop of join and both arrays holds all rows that it makes from one box
    each = met.select(*sides, "_r_rows", F.inline(F.transform("_l_rows", lambda row: row))).select("*", F.inline("_r_rows"))
    return each.select(*left.columns, *right.columns)


def prefixed(frame: DataFrame, prefix: str) -> DataFrame:
    return frame.select(*(F.col(c).alias(prefix + c) for c in frame.columns))


def _new_areas(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of boxes sorted by rank the area that no box of a smaller rank covers, and of that what no earlier box has either."""
    if len(x0) == 1:
        area = (x1 - x0) * (y1 - y0)
        return area, area
    xs, ys = np.unique(np.concatenate([x0, x1])), np.unique(np.concatenate([y0, y1]))
    wide, high = np.diff(xs), np.diff(ys)
    a0, a1, b0, b1 = np.searchsorted(xs, x0), np.searchsorted(xs, x1), np.searchsorted(ys, y0), np.searchsorted(ys, y1)
    free = np.ones((len(wide), len(high)), bool)
    new, own, left = np.zeros(len(x0)), np.zeros(len(x0)), free.size
    edges = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1], [True]]))
    for first, past in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        for i in range(first, past):
            new[i] = wide[a0[i] : a1[i]] @ free[a0[i] : a1[i], b0[i] : b1[i]] @ high[b0[i] : b1[i]]
        for i in range(first, past):
            part = free[a0[i] : a1[i], b0[i] : b1[i]]
            own[i] = new[i] if past == first + 1 else wide[a0[i] : a1[i]] @ part @ high[b0[i] : b1[i]]
            left -= int(part.sum())
            part[:] = False
        if not left:  # the region is covered, older tiles add nothing
            break
    return new, own


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one region's part after the other, (part, rank, x0, x1, y0, y1, ...): with new_area and own_area in the places of the last four."""
    held: pa.Table | None = None

    def areas(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        part, rank, *sides = (table.column(k).to_numpy() for k in range(6))
        new, own = np.zeros(len(part)), np.zeros(len(part))
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            new[a:b], own[a:b] = _new_areas(*(s[a:b] for s in sides), rank[a:b])
        rest = table.to_batches()[0].columns[6:] if len(part) else [c.combine_chunks() for c in table.columns[6:]]
        return pa.RecordBatch.from_arrays([pa.array(new), pa.array(own), *rest], names=["new_area", "own_area", *table.column_names[6:]])

    for batch in batches:
        own = pa.Table.from_batches([batch])
        held = own if held is None else pa.concat_tables([held, own])
        part = held.column(0).to_numpy()
        changes = np.flatnonzero(part[1:] != part[:-1])
        whole = int(changes[-1]) + 1 if len(changes) else 0
        if whole:
            yield areas(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield areas(held)


def newest_first(pairs: DataFrame, region: str = "l_region_id", rank: str = "rank", tolerance: float = 1e-9, dense: int = DENSE) -> DataFrame:
    """For each region and tile the area that no tile of a smaller rank covers (new_area), whether it is selected, and own_area, of
    which each place of a region counts once.

    Tiles of one rank do not cover each other in new_area. A region's tiles are swept from the newest on over the cells that
    their edges cut, until it is covered; one with more than dense tiles is cut into parts first, so a task holds a bounded grid.
    """
    keys = [c for c in pairs.columns if c.startswith(("l_", "r_"))] + [rank]
    many = F.count(F.lit(1)).over(Window.partitionBy(region))
    rows = pairs.select(*keys).withColumn("_n", F.ceil(F.sqrt(many / F.lit(dense))).cast("int"))
    for low, high, name in (("minx", "maxx", "x"), ("miny", "maxy", "y")):
        first, last = F.greatest(f"l_{low}", f"r_{low}"), F.least(f"l_{high}", f"r_{high}")
        width = (F.col(f"l_{high}") - F.col(f"l_{low}")) / F.col("_n")
        at = lambda v: F.least(F.greatest(F.floor((v - F.col(f"l_{low}")) / width).cast("int"), F.lit(0)), F.col("_n") - 1)  # noqa: B023, E731
        rows = rows.withColumn(f"_{name}", F.explode(F.sequence(at(first), at(last))))
        edge = lambda k: F.when(k >= F.col("_n"), F.col(f"l_{high}")).otherwise(F.col(f"l_{low}") + k * width)  # noqa: B023, E731
        rows = rows.withColumn(f"{name}0", F.greatest(first, edge(F.col(f"_{name}")))).withColumn(f"{name}1", F.least(last, edge(F.col(f"_{name}") + 1)))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.where("x0 < x1 and y0 < y1").repartition(parts, region, "_x", "_y").sortWithinPartitions(region, "_x", "_y", rank)
    keyed = dealt.select(F.xxhash64(region, "_x", "_y").alias("_part"), F.col(rank).cast("double").alias("_rank"), "x0", "x1", "y0", "y1", *keys)
    schema = T.StructType([T.StructField("new_area", T.DoubleType()), T.StructField("own_area", T.DoubleType()), *(keyed.schema[k] for k in keys)])
    swept = keyed.mapInArrow(_sweep, schema).groupBy(*keys).agg(F.sum("new_area").alias("new_area"), F.sum("own_area").alias("own_area"))
    area = (F.col("l_maxx") - F.col("l_minx")) * (F.col("l_maxy") - F.col("l_miny"))
    return swept.withColumn("selected", F.col("new_area") > F.greatest(area, F.lit(1.0)) * tolerance)


def alike(regions: DataFrame, region: str = "l_region_id") -> tuple[DataFrame, DataFrame]:
    """Kinds of regions, those with the same boxes: (l_kind, sides of l_) and (l_kind, region), one row a region."""
    listed = regions.groupBy(region).agg(F.sort_array(F.collect_list(F.struct(*(F.col(f"l_{s}").alias(s) for s in SIDES)))).alias("l_kind"))
    kinds = listed.select("l_kind").distinct().select("l_kind", F.inline("l_kind"))
    return kinds.withColumnsRenamed({s: f"l_{s}" for s in SIDES}), listed


def newest_of_kinds(kinds: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    """newest_first of kinds of regions and of different boxes of tiles (sides of r_ and r_rank), each at the least of its ranks: a tile
    adds nothing where another of the same box is newer. r_last is the greatest rank of a box."""
    once = tiles.groupBy(*(f"r_{s}" for s in SIDES)).agg(F.min("r_rank").alias("r_rank"), F.max("r_rank").alias("r_last"))
    return newest_first(_meet(kinds, once, size).withColumn("rank", F.col("r_rank")), "l_kind")


def newest_tiles(regions: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    """(l_region_id, r_tile_id, rank, new_area): the selected tiles of each region, by kinds."""
    kinds, listed = alike(regions)
    found = newest_of_kinds(kinds, tiles, size).where("selected")
    sides = [f"r_{s}" for s in SIDES]
    # rows that repeat a tile count as often as they stand there
    own = _lots(tiles.groupBy("r_tile_id", *sides, "r_rank").agg(F.count(F.lit(1)).alias("times")), [*sides, "r_rank"], "_tiles")
    wide = found.join(own, [*sides, "r_rank"]).select("l_kind", "rank", "new_area", "_tiles").join(_lots(listed, ["l_kind"], "_regions"), "l_kind")
    dealt = wide.repartition(TASKS * int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    each = dealt.select("rank", "new_area", "_tiles", F.inline(F.transform("_regions", lambda row: row))).select("*", F.inline("_tiles"))
    return each.select("l_region_id", "r_tile_id", "rank", (F.col("new_area") * F.col("times")).alias("new_area"))


def coverage(selected: DataFrame, regions: DataFrame) -> DataFrame:
    """Covered share of each region of regions (l_ columns), from newest_first's rows; 0 without tiles."""
    gained = selected.groupBy("l_region_id").agg(F.sum("own_area").alias("covered"))
    area = (F.col("l_maxx") - F.col("l_minx")) * (F.col("l_maxy") - F.col("l_miny"))
    return regions.join(gained, "l_region_id", "left").withColumn("ratio", F.coalesce("covered", F.lit(0.0)) / area)


def covered(regions: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    """coverage of regions by tiles, by kinds."""
    kinds, listed = alike(regions)
    gained = newest_of_kinds(kinds, tiles, size).groupBy("l_kind").agg(F.sum("own_area").alias("own_area"))
    return coverage(listed.join(gained, "l_kind"), regions)


def early_close(selected: DataFrame, rank: str = "rank", tolerance: float = 1e-6, region: str = "l_region_id", last: str | None = None) -> DataFrame:
    """(region_id, closed_at, last_rank): the first rank at which the tiles so far cover a region as a whole, if they do.

    last names the greatest rank that a row of selected stands for, where that is not its rank."""
    area = (F.col("l_maxx") - F.col("l_minx")) * (F.col("l_maxy") - F.col("l_miny"))
    per = selected.groupBy(region, rank).agg(F.sum("own_area").alias("gained"), F.first(area).alias("area"), F.max(last or rank).alias("_last"))
    so_far = F.sum("gained").over(Window.partitionBy(region).orderBy(rank))
    out = per.withColumn("so_far", so_far).groupBy(F.col(region).alias("region_id"))
    return out.agg(F.min(F.when(F.col("so_far") >= F.col("area") - tolerance, F.col(rank))).alias("closed_at"), F.max("_last").alias("last_rank"))


def closed_regions(regions: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    """early_close of regions by tiles, by kinds."""
    kinds, listed = alike(regions)
    closed = early_close(newest_of_kinds(kinds, tiles, size), region="l_kind", last="r_last")
    return listed.join(closed.withColumnRenamed("region_id", "l_kind"), "l_kind").select(F.col("l_region_id").alias("region_id"), "closed_at", "last_rank")


def footprint_join(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs whose polygons (l_rings, r_rings) share area, with shared_area. Sides must be the polygons' bounds.

    Boxes meet through cells first; only pairs whose boxes overlap are measured. Null shapes meet nothing.
    """
    near = box_join(left, right, size).where(F.col("l_rings").isNotNull() & F.col("r_rings").isNotNull())
    return near.withColumn("shared_area", polygons.shared_area("l_rings", "r_rings")).where("shared_area > 0")
