"""Queries of alignment, windows about points, run state, work units and portals, with SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import crs, polygons, text
from geoloom.operators import alignment, assets, boxes, planning, runstate
from geoloom.plans.catalogue import query, rounded, table
from geoloom.sources import catalogs, portals, regions, units

# Rasters: three sources of 48 by 40 cells, shifted against each other, and a target that lies across them

ZONE = "EPSG:32618"
_ONE = "SELECT raster_id, row, col, max(value) AS value FROM {cells} GROUP BY raster_id, row, col"
_GRIDS = "SELECT * FROM (VALUES (0, 'a.tif', 1000.0, 2000.0), (1, 'b.tif', 1150.0, 1930.0), (2, 'c.tif', 1305.0, 1860.0)) t(raster_id, path, c, f)"


def _sources(spark) -> DataFrame:
    grids = spark.createDataFrame([(0, "a.tif", 1000.0, 2000.0), (1, "b.tif", 1150.0, 1930.0), (2, "c.tif", 1305.0, 1860.0)], "raster_id int, path string, c double, f double")
    return grids.select(F.lit("t").alias("region_id"), "raster_id", "path", F.lit(1).alias("bands"), F.lit(10.0).alias("a"), F.lit(0.0).alias("b"), "c", F.lit(0.0).alias("d"), F.lit(-10.0).alias("e"), "f", F.lit(40).alias("width"), F.lit(48).alias("height"), F.lit(ZONE).alias("crs"))


def _target(spark) -> DataFrame:
    return spark.createDataFrame([("t", 12.0, 0.0, 1003.0, 0.0, -12.0, 1995.0, 60, 50, ZONE)], "region_id string, a double, b double, c double, d double, e double, f double, width int, height int, crs string")


def _cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy("raster_id", "row", "col").agg(F.max("value").alias("value"))


def _aligned(spark, cells, method, merge):
    pairs = alignment.pair_grids(_target(spark), _sources(spark), 1000.0)
    return alignment.align(pairs, _cells(cells), method, merge).select("region_id", "row", "col", rounded("value").alias("value"))


_TARGET_CELLS = "SELECT r.row, c.col, 1003 + 12 * (c.col + 0.5) AS x, 1995 - 12 * (r.row + 0.5) AS y FROM range(50) r(row), range(60) c(col)"


def _nearest_sql(pick: str) -> str:
    return f"WITH s AS ({_ONE}), g AS ({_GRIDS}), t AS ({_TARGET_CELLS}) SELECT 't' AS region_id, t.row, t.col, round(arg_{pick}(s.value, g.path), 6) AS value FROM t JOIN g ON t.x >= g.c AND t.x < g.c + 400 AND t.y <= g.f AND t.y > g.f - 480 JOIN s ON s.raster_id = g.raster_id AND s.col = floor((t.x - g.c) / 10) AND s.row = floor((g.f - t.y) / 10) WHERE s.value IS NOT NULL GROUP BY t.row, t.col"


@query("r02_align_nearest", _nearest_sql("min"), "cells")
def _(spark, sf_dir, cells):
    return _aligned(spark, cells, "nearest", "first")


@query("r02_align_nearest_last", _nearest_sql("max"), "cells")
def _(spark, sf_dir, cells):
    return _aligned(spark, cells, "nearest", "last")


def _area_sql(how: str) -> str:
    return f"WITH s AS ({_ONE}), g AS ({_GRIDS}), p AS (SELECT g.path, s.value, floor((g.c + 10 * (s.col + 0.5) - 1003) / 12)::bigint AS col, floor((1995 - (g.f - 10 * (s.row + 0.5))) / 12)::bigint AS row FROM s JOIN g USING (raster_id) WHERE s.value IS NOT NULL), v AS (SELECT path, row, col, {how} AS value FROM p WHERE row BETWEEN 0 AND 49 AND col BETWEEN 0 AND 59 GROUP BY path, row, col) SELECT 't' AS region_id, row, col, round(arg_min(value, path), 6) AS value FROM v GROUP BY row, col"


for _name, _how in (("average", "avg(value)"), ("max", "max(value)"), ("med", "quantile_cont(value, 0.5)"), ("rms", "sqrt(avg(value * value))")):

    @query(f"r02_align_{_name}", _area_sql(_how), "cells")
    def _(spark, sf_dir, cells, _name=_name):
        return _aligned(spark, cells, _name, "first")


# weights of the four cells about a place, over those that have a value
@query("r02_align_bilinear", f"WITH s AS ({_ONE}), g AS ({_GRIDS}), t AS ({_TARGET_CELLS}), p AS (SELECT t.row, t.col, g.raster_id, g.path, (t.x - g.c) / 10 - 0.5 AS u, (g.f - t.y) / 10 - 0.5 AS v FROM t JOIN g ON t.x >= g.c AND t.x < g.c + 400 AND t.y <= g.f AND t.y > g.f - 480), n AS (SELECT p.*, floor(u) + i.i AS sc, floor(v) + j.j AS sr FROM p, range(2) i(i), range(2) j(j)), w AS (SELECT n.row, n.col, n.path, s.value, greatest(1 - abs(u - sc), 0) * greatest(1 - abs(v - sr), 0) AS w FROM n JOIN s ON s.raster_id = n.raster_id AND s.row = n.sr AND s.col = n.sc WHERE s.value IS NOT NULL), z AS (SELECT row, col, path, sum(w * value) / nullif(sum(w), 0) AS value FROM w GROUP BY row, col, path) SELECT 't' AS region_id, row, col, round(arg_min(value, path), 6) AS value FROM z WHERE value IS NOT NULL GROUP BY row, col", "cells")
def _(spark, sf_dir, cells):
    return _aligned(spark, cells, "bilinear", "first")


@query("m14_target_grid", "SELECT 't' AS region_id, 24.0 AS a, -24.0 AS e, 1003.0 AS c, 1995.0 AS f, 30 AS width, 25 AS height")
def _(spark, sf_dir):
    return alignment.target_grid(_target(spark), 2).select("region_id", "a", "e", "c", "f", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"))


_BOXES = "SELECT c_custkey, 950 + (c_custkey * 37) % 400 + 0.25 AS minx, 1500 + (c_custkey * 53) % 450 + 0.75 AS miny, 950 + (c_custkey * 37) % 400 + 30.5 + c_nationkey AS maxx, 1500 + (c_custkey * 53) % 450 + 25.25 + c_nationkey AS maxy FROM customer"


def _crops(spark, sf_dir):
    own = table(spark, sf_dir, "customer").selectExpr("c_custkey AS region_id", "950 + (c_custkey * 37) % 400 + 0.25D AS minx", "1500 + (c_custkey * 53) % 450 + 0.75D AS miny", "950 + (c_custkey * 37) % 400 + 30.5D + c_nationkey AS maxx", "1500 + (c_custkey * 53) % 450 + 25.25D + c_nationkey AS maxy")
    grids = _sources(spark).where("raster_id = 0").drop("region_id", "bands")
    return own.crossJoin(F.broadcast(grids.select("raster_id", *(F.col(k).alias(f"s_{k}") for k in alignment.GRID))))  # one grid


@query("r03_native_crop", f"WITH s AS ({_ONE}), b AS ({_BOXES}), w AS (SELECT *, floor((minx - 1000) / 10) AS c0, ceil((maxx - 1000) / 10) AS c1, floor((2000 - maxy) / 10) AS r0, ceil((2000 - miny) / 10) AS r1 FROM b) SELECT c_custkey AS region_id, (s.row - r0)::bigint AS row, (s.col - c0)::bigint AS col, s.value FROM w JOIN s ON s.raster_id = 0 AND s.row >= r0 AND s.row < r1 AND s.col >= c0 AND s.col < c1", "cells")
def _(spark, sf_dir, cells):
    return alignment.native_crop(_crops(spark, sf_dir), _cells(cells)).select("region_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "value")


@query("m15_clipped_windows", f"WITH b AS ({_BOXES}) SELECT c_custkey AS region_id, greatest(floor((minx - 1000) / 10), 0)::bigint AS col0, greatest(floor((2000 - maxy) / 10), 0)::bigint AS row0, least(ceil((maxx - 1000) / 10), 40)::bigint AS col1, least(ceil((2000 - miny) / 10), 48)::bigint AS row1 FROM b")
def _(spark, sf_dir):
    return _crops(spark, sf_dir).select("region_id", *(c.alias(n) for c, n in zip(alignment.clipped_window("s_"), ("col0", "row0", "col1", "row1"), strict=True)))


_POINTS = "SELECT c_custkey AS point_id, 1010 + (c_custkey * 97) % 660 + 0.5 AS x, 1450 + (c_custkey * 31) % 540 + 0.25 AS y FROM customer"
_ANCHORED = f"WITH p AS ({_POINTS}), g AS ({_GRIDS}), m AS (SELECT p.*, g.*, (x - c) / 10 AS pc, (f - y) / 10 AS pr FROM p JOIN g ON x BETWEEN c AND c + 400 AND y BETWEEN f - 480 AND f), b AS (SELECT *, least(pc, 40 - pc, pr, 48 - pr) AS margin FROM m), o AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY margin DESC, path DESC) = 1)"


def _anchored(spark, sf_dir):
    points = table(spark, sf_dir, "customer").selectExpr("c_custkey AS point_id", "1010 + (c_custkey * 97) % 660 + 0.5D AS x", "1450 + (c_custkey * 31) % 540 + 0.25D AS y")
    return alignment.point_windows(alignment.anchors(points, _sources(spark), 500.0), 64.0)


@query("a15_anchor_rasters", f"{_ANCHORED} SELECT point_id, path FROM o")
def _(spark, sf_dir):
    return _anchored(spark, sf_dir).select("point_id", "path")


@query("r04_point_windows", f"{_ANCHORED} SELECT point_id, path, 6 AS width, 6 AS height, round_even(pc - 3, 0)::bigint AS col0, round_even(pr - 3, 0)::bigint AS row0 FROM o")
def _(spark, sf_dir):
    return _anchored(spark, sf_dir).select("point_id", "path", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), "col0", "row0")


def _fitted(spark, sf_dir):
    windows = _anchored(spark, sf_dir).withColumn("region_id", F.lit("t"))
    return alignment.fit_of_sources(windows, _sources(spark))


# c.tif lies half a cell off the others' grid, so it fits only its own windows
_MOSAIC = f"{_ANCHORED}, w AS (SELECT point_id, path AS anchor, c AS ac, f AS af, round_even(pc - 3, 0) AS col0, round_even(pr - 3, 0) AS row0 FROM o), s AS ({_ONE}), n AS (SELECT w.*, g.raster_id, g.path, (ac + 10 * col0 - g.c) / 10 AS dc, (g.f - af + 10 * row0) / 10 AS dr FROM w JOIN g ON abs((ac - g.c) / 10 - round((ac - g.c) / 10)) < 1e-9), v AS (SELECT n.point_id, n.path, n.anchor, s.value, s.row - dr AS row, s.col - dc AS col FROM n JOIN s ON s.raster_id = n.raster_id AND s.row - dr BETWEEN 0 AND 5 AND s.col - dc BETWEEN 0 AND 5 WHERE s.value IS NOT NULL)"


@query("r04_native_mosaic", f"{_MOSAIC} SELECT point_id, row::bigint AS row, col::bigint AS col, arg_min(value, CASE WHEN path = anchor THEN '' ELSE path END) AS value, arg_min(path, CASE WHEN path = anchor THEN '' ELSE path END) AS source_path FROM v GROUP BY ALL", "cells")
def _(spark, sf_dir, cells):
    out = alignment.native_mosaic(_fitted(spark, sf_dir), _cells(cells))
    return out.select("point_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "value", "source_path")


@query("r04_window_report", f"{_MOSAIC}, q AS (SELECT point_id, count(DISTINCT (row, col)) AS n FROM v GROUP BY point_id) SELECT w.point_id, 36 AS total, coalesce(n, 0) AS n_valid, round(coalesce(n, 0) / 36.0, 6) AS valid_fraction, coalesce(n, 0) >= 18 AS enough FROM w LEFT JOIN q USING (point_id)", "cells")
def _(spark, sf_dir, cells):
    fitted = _fitted(spark, sf_dir)
    native = alignment.native_mosaic(fitted, _cells(cells)).withColumn("resampled", F.lit(False))
    return alignment.window_report(fitted, native, 0.5).select("point_id", F.col("total").cast("int").alias("total"), "n_valid", rounded("valid_fraction").alias("valid_fraction"), "enough")


@query("m23_vertical_mismatch", "WITH d AS (SELECT concat('n', n_nationkey) AS region_id, CASE WHEN n_regionkey = 0 THEN NULL ELSE concat('v', n_regionkey) END AS s, 'v1' AS t FROM nation), m AS (SELECT region_id, concat('region=', region_id, ' source=', coalesce(s, 'unknown'), ' target=', t) AS said FROM d WHERE s IS DISTINCT FROM t) SELECT (SELECT count(*) FROM m) AS n, concat((SELECT string_agg(said, '; ' ORDER BY region_id) FROM (SELECT * FROM m ORDER BY region_id LIMIT 3)), '; plus ', (SELECT count(*) - 3 FROM m), ' more regions') AS message")
def _(spark, sf_dir):
    return alignment.vertical_mismatches(table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("region_id"), F.when(F.col("n_regionkey") != 0, F.concat(F.lit("v"), "n_regionkey")).alias("source_vertical"), F.lit("v1").alias("target_vertical")))


# The log of a run: an order is a file, its lines what happens to it; customers are targets, parts what happens to these

_PIPE = "concat('p', cast({0} % 3 as string))"
_FILE_LOG = f"SELECT {_PIPE.format('(l_orderkey % 300 + 1)')} AS pipeline, l_orderkey * 10 + l_linenumber AS seq, (l_orderkey * 10 + l_linenumber) / 8e0 AS ts, case l_linenumber when 1 then 'request' when 2 then 'started' when 3 then 'transfer' when 4 then 'finished' when 5 then 'duplicate' when 6 then 'issue' else 'planned' end AS kind, concat('r', cast(l_orderkey % 300 + 1 as string)) AS region_id, concat('f', cast(l_orderkey as string)) AS key, case when l_linenumber = 3 then case when l_orderkey % 4 = 0 then 'existing' else 'success' end end AS status, case l_linenumber when 1 then concat('u', cast(l_orderkey as string)) when 4 then case when l_orderkey % 11 = 0 then 'broken' end when 6 then 'no rule' end AS text, cast(l_orderkey % 1000 as double) AS amount FROM lineitem"
_REGION_LOG = f"SELECT {_PIPE.format('c_custkey')} AS pipeline, -c_custkey AS seq, 0e0 AS ts, 'region' AS kind, concat('r', cast(c_custkey as string)) AS region_id, concat('o', cast(c_custkey as string)) AS key, case when c_custkey % 13 = 0 then 'existing' else 'pending' end AS status, concat('in', cast(c_custkey as string)) AS text, cast(null as double) AS amount FROM customer WHERE c_custkey <= 300"
_STEP_LOG = f"SELECT {_PIPE.format('(p_partkey % 280 + 1)')} AS pipeline, 1000000000000 + p_partkey AS seq, 1e9 + p_partkey AS ts, case (p_partkey // 280) % 3 when 0 then 'ready' when 1 then 'building' else 'built' end AS kind, concat('r', cast(p_partkey % 280 + 1 as string)) AS region_id, case when (p_partkey // 280) % 3 = 2 and p_partkey % 5 <> 0 then concat('o', cast(p_partkey % 280 + 1 as string)) end AS key, cast(null as string) AS status, case when (p_partkey // 280) % 3 = 2 and p_partkey % 7 = 0 then 'no cells' end AS text, cast(null as double) AS amount FROM part WHERE p_partkey < 280 * 3 - p_partkey % 280 * 2"
_CLOSED_LOG = "SELECT concat('p', cast(r_regionkey as string)) AS pipeline, 2000000000000 AS seq, 2e9 AS ts, 'closed' AS kind, cast(null as string) AS region_id, cast(null as string) AS key, cast(null as string) AS status, cast(null as string) AS text, cast(null as double) AS amount FROM region WHERE r_regionkey < 2"
_LOG = " UNION ALL ".join((_FILE_LOG, _REGION_LOG, _STEP_LOG, _CLOSED_LOG))
_LOG_SQL = _LOG.replace("as string", "as varchar")


def _log(spark, sf_dir) -> DataFrame:
    for name in ("lineitem", "customer", "part", "region"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"_log_{name}")
    sql = _LOG.replace(" // ", " div ")
    for name in ("lineitem", "customer", "part", "region"):
        sql = sql.replace(f"FROM {name}", f"FROM _log_{name}")
    return spark.sql(sql)


_FILES = f"e AS ({_LOG_SQL}), f AS (SELECT pipeline, key, max(text) FILTER (kind = 'request') AS url, count(*) FILTER (kind = 'duplicate') AS duplicates, max(status) FILTER (kind = 'transfer') AS transfer, bool_or(kind = 'started') AS started, bool_or(kind = 'finished') AS finished, max(text) FILTER (kind = 'finished') AS error FROM e WHERE kind IN ('request', 'duplicate', 'started', 'transfer', 'finished') GROUP BY pipeline, key), fs AS (SELECT *, CASE WHEN finished AND error IS NOT NULL THEN 'failed' WHEN finished AND transfer = 'existing' THEN 'existing' WHEN finished THEN 'complete' WHEN started THEN 'running' ELSE 'planned' END AS status FROM f)"


@query("t08_file_states", f"WITH {_FILES} SELECT pipeline, key, url, status, transfer, duplicates, error FROM fs")
def _(spark, sf_dir):
    return runstate.file_states(_log(spark, sf_dir)).select("pipeline", "key", "url", "status", "transfer", "duplicates", "error")


_WANTS = "wn AS (SELECT e.pipeline, e.region_id, e.key, fs.status FROM (SELECT DISTINCT pipeline, region_id, key FROM e WHERE kind IN ('request', 'duplicate')) e JOIN fs USING (pipeline, key)), rf AS (SELECT pipeline, region_id, count(*) AS required, count(*) FILTER (status IN ('complete', 'existing')) AS completed, count(*) FILTER (status = 'failed') AS failed FROM wn GROUP BY pipeline, region_id)"


@query("a32_region_files", f"WITH {_FILES}, {_WANTS} SELECT * FROM rf")
def _(spark, sf_dir):
    out = runstate.region_files(_log(spark, sf_dir))
    return out.select("pipeline", "region_id", *(F.size(c).cast("long").alias(c) for c in ("required", "completed", "failed")))


_STATES = "o AS (SELECT pipeline, region_id, bool_or(kind = 'region' AND status = 'existing') AS existing, arg_max(kind, seq) FILTER (kind <> 'region') AS last, bool_or(kind = 'region') AS known, arg_max(coalesce(text, ''), seq) FILTER (kind = 'built') AS said, max(key) FILTER (kind = 'region') AS wanted, list(key) FILTER (kind = 'built') AS made FROM e WHERE kind IN ('region', 'ready', 'building', 'built') GROUP BY pipeline, region_id), rs AS (SELECT o.pipeline, o.region_id, CASE WHEN existing AND last IS NULL THEN 'existing' WHEN last = 'built' AND (said <> '' OR NOT list_contains(list_filter(made, lambda m: m IS NOT NULL), wanted)) THEN 'failed' WHEN last = 'built' THEN 'complete' WHEN o.pipeline IN ('p0', 'p1') AND coalesce(rf.failed, 0) > 0 THEN 'failed' WHEN o.pipeline IN ('p0', 'p1') THEN 'unavailable' WHEN last IS NULL THEN 'pending' ELSE last END AS state FROM o LEFT JOIN rf USING (pipeline, region_id))"


@query("a31_region_states", f"WITH {_FILES}, {_WANTS}, {_STATES} SELECT pipeline, region_id, state FROM rs")
def _(spark, sf_dir):
    return runstate.region_states(_log(spark, sf_dir)).select("pipeline", "region_id", "state")


@query("a10_run_states", f"WITH {_FILES}, {_WANTS}, {_STATES}, r AS (SELECT pipeline, count(*) AS regions, count(*) FILTER (state = 'complete') AS regions_complete, count(*) FILTER (state = 'failed') AS regions_failed, count(*) FILTER (state = 'unavailable') AS regions_unavailable, count(*) FILTER (state NOT IN ('complete', 'existing')) AS regions_remaining FROM rs GROUP BY pipeline), c AS (SELECT pipeline, count(*) AS files, count(*) FILTER (status = 'failed') AS files_failed, count(*) FILTER (transfer = 'success') AS downloaded, sum(duplicates)::bigint AS duplicates, count(*) - count(*) FILTER (status IN ('complete', 'existing', 'failed')) AS files_remaining FROM fs GROUP BY pipeline), i AS (SELECT pipeline, count(*) FILTER (kind = 'issue') AS issues FROM e GROUP BY pipeline) SELECT r.*, files, files_failed, downloaded, duplicates, files_remaining, issues, CASE WHEN r.pipeline = 'p2' THEN 'running' WHEN regions_failed + regions_unavailable > 0 THEN 'failed' ELSE 'complete' END AS status FROM r JOIN c USING (pipeline) JOIN i USING (pipeline)")
def _(spark, sf_dir):
    return runstate.summary(_log(spark, sf_dir)).select("pipeline", "regions", "regions_complete", "regions_failed", "regions_unavailable", "regions_remaining", "files", "files_failed", "downloaded", "duplicates", "files_remaining", "issues", "status")


@query("a11_active_since", f"WITH e AS ({_LOG_SQL}), s AS (SELECT pipeline, ts, seq, CASE kind WHEN 'started' THEN 1 ELSE -1 END AS d FROM e WHERE kind IN ('started', 'finished')), a AS (SELECT pipeline, ts, greatest(sum(d) OVER w, 0) AS active, lead(ts) OVER (PARTITION BY pipeline ORDER BY ts, seq) AS until FROM s WINDOW w AS (PARTITION BY pipeline ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), m AS (SELECT pipeline, greatest(ts, 20000) AS ts, until, active FROM a WHERE until > 20000) SELECT p.pipeline, coalesce(round(sum(active * (until - m.ts)) FILTER (active > 0) / sum(until - m.ts) FILTER (active > 0), 2), 0.0) AS average_active FROM (SELECT DISTINCT pipeline FROM e) p LEFT JOIN m ON m.pipeline = p.pipeline GROUP BY p.pipeline")
def _(spark, sf_dir):
    log = _log(spark, sf_dir)
    return runstate.average_active(log, log.select("pipeline").distinct().withColumn("ts", F.lit(20000.0)))


@query("u08_errors", f"WITH {_FILES} SELECT pipeline, category, count(*) AS n FROM (SELECT pipeline, 'planning' AS category FROM e WHERE kind = 'issue' UNION ALL SELECT pipeline, 'file' FROM fs WHERE status = 'failed' UNION ALL SELECT concat('p', n_nationkey % 3), 'run' FROM nation) GROUP BY ALL")
def _(spark, sf_dir):
    before = table(spark, sf_dir, "nation").select(F.concat(F.lit("p"), (F.col("n_nationkey") % 3).cast("string")).alias("pipeline"), F.lit("run").alias("category"), F.lit(None).cast("string").alias("subject"), F.lit("x").alias("error"))
    return runstate.errors(_log(spark, sf_dir), before).where("category <> 'region'").groupBy("pipeline", "category").agg(F.count("*").alias("n"))


@query("j15_merged_results", "SELECT c_custkey AS region_id, CASE WHEN c_custkey % 4 = 0 THEN concat('old', c_custkey) WHEN c_custkey % 3 = 0 THEN concat('new', c_custkey) END AS result FROM customer")
def _(spark, sf_dir):
    order = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("region_id"))
    some = lambda n, name: order.where(f"region_id % {n} = 0").select("region_id", F.concat(F.lit(name), "region_id").alias("result"))
    return runstate.merged_in_order(order, some(3, "new"), some(4, "old"))


@query("a29_terminal_outputs", "SELECT o_custkey AS region_id, o_orderpriority AS product, arg_max(concat('o', o_orderkey), o_orderkey) AS path FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY ALL")
def _(spark, sf_dir):
    expected = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("region_id"), F.col("o_orderkey").alias("step"), F.col("o_orderpriority").alias("product"), F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("o"), "o_orderkey")).alias("path"))
    return runstate.terminal_outputs(expected).select("region_id", "product", "path")


# Lists of links and work units

_LINK = "concat(case when k % 9 = 0 then 'https:/host/a/' else 'https://host/a/' end, case when k % 10 = 0 then 'readme.txt' when k % 7 = 0 then concat('ABC', a, '_.laz') else concat('t_', substr(a, 1, 3), case when k % 2 = 0 then '.laz' else '.LAS' end) end, case when k % 3 = 0 then '?v=1' else '' end)"


def _links(names: DataFrame) -> DataFrame:
    return names.select(F.concat(F.lit("l"), (F.col("k") % 5).cast("string")).alias("list_url"), F.expr(_LINK).alias("link"), F.lit(None).cast("string").alias("error"))


@query("s10_cloud_files", "SELECT concat('l', k % 5) AS list_url, CASE WHEN k % 7 = 0 THEN concat('ABC', a, '_.laz') ELSE concat('t_', substr(a, 1, 3), CASE WHEN k % 2 = 0 THEN '.laz' ELSE '.LAS' END) END AS filename, any_value(k % 7 = 0) AS placeholder, count(*) AS n FROM {names} WHERE k % 10 <> 0 GROUP BY 1, 2", "names")
def _(spark, sf_dir, names):
    return units.cloud_files(_links(names)).select("list_url", "filename", "placeholder", "n")


@query("n50_repaired_links", f"SELECT k, regexp_replace({_LINK}, '^https:/([^/])', 'https://\\1') AS url FROM {{names}}", "names")
def _(spark, sf_dir, names):
    return names.select("k", text.normalized_link(F.expr(_LINK)).alias("url"))


@query("a07_units_of_regions", "SELECT r.tile_id % 40 AS unit, count(DISTINCT l.region_id) AS regions FROM {regions} l JOIN {tiles} r ON l.minx <= r.maxx AND r.minx <= l.maxx AND l.miny <= r.maxy AND r.miny <= l.maxy GROUP BY 1", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    unit = tiles.select((F.col("tile_id") % 40).alias("unit"), *boxes.SIDES)
    return units.unit_targets(regions, unit, 64.0)


@query("c14_owned_requests", "SELECT concat('f', l_partkey % 500) AS filename, arg_min(concat('u', l_suppkey), (l_linenumber, concat('u', l_suppkey))) AS url, min(concat('r', l_suppkey)) AS region_id, count(DISTINCT concat('r', l_suppkey)) AS targets, count(DISTINCT concat('u', l_suppkey)) - 1 AS duplicates FROM lineitem GROUP BY 1")
def _(spark, sf_dir):
    chosen = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("f"), (F.col("l_partkey") % 500).cast("string")).alias("filename"), F.concat(F.lit("u"), "l_suppkey").alias("url"), F.concat(F.lit("r"), "l_suppkey").alias("region_id"), F.lit("w").alias("workunit"), F.col("l_linenumber").alias("rank"))
    return units.requests(chosen).select("filename", "url", "region_id", F.size("target_region_ids").cast("long").alias("targets"), "duplicates")


# Portals

_TABLE = "concat('<table><tr id=\"x\"><td id=\"target_', cast(k as string), '\">MDT50CM-', a, '.tif</td></tr><tr><td id=\"linkDescDir_9', c, '\">other-', b, '.tif</td></tr><tr><td>MDT50CM-', b, '.tif</td></tr></table>')"


@query("s16_table_files", "SELECT k, k::varchar AS sequential, concat('MDT50CM-', a, '.tif') AS filename FROM {names}", "names")
def _(spark, sf_dir, names):
    return portals.file_rows(names.select("k", F.expr(_TABLE).alias("document")), "MDT50CM-")


_SHEET = "concat('SC-25-V-A-', case k % 6 when 0 then 'I' when 1 then 'II' when 2 then 'III' when 3 then 'IV' when 4 then 'V' else 'VI' end, '-', cast(k % 4 + 1 as string), '-', case k % 5 when 0 then 'NO' when 1 then 'NE' when 2 then 'SO' else 'SE' end, '-A-I')"


@query("s19_sheet_downloads", f"WITH n AS (SELECT k, {_SHEET.replace('as string', 'as varchar')} AS sheet FROM {{names}} WHERE k < 60) SELECT sheet, min(concat('https://pe3d.pe.gov.br/d/1_5000/4_MDT_RASTER/MDT-', sheet, '.zip')) AS url, min(concat('MDT-', sheet, '.zip')) AS filename FROM n WHERE k % 3 <> 0 AND sheet IN (SELECT sheet FROM n WHERE k % 2 = 0) GROUP BY sheet", "names")
def _(spark, sf_dir, names):
    rows = names.where("k < 60").select("k", F.expr(_SHEET).alias("sheet"))
    frame = F.concat(F.lit('<iframe width="1" src="'), F.when(F.col("k") % 2 == 0, "https://pe3d.pe.gov.br").otherwise(""), F.lit("/d/1_5000/"), F.when(F.col("k") % 3 != 0, "4%5FMDT%5FRASTER").otherwise("5_MDT_XYZ"), F.lit("/MDT-"), "sheet", F.lit('.zip"></iframe>'))
    spec = portals.product("pe3d", "dtm_raster")
    plain = F.replace(frame, F.lit("4%5FMDT%5FRASTER"), F.lit("4_MDT_RASTER"))
    return portals.sheet_downloads(rows.select(plain.alias("document")), rows.where("k % 2 = 0").select("sheet"), "https://pe3d.pe.gov.br/", spec)


@query("j09_resolved_sheets", "SELECT k AS sheet, CASE WHEN k % 5 = 0 THEN 'skipped' WHEN k % 3 = 0 OR k % 4 = 0 THEN 'failed' ELSE 'planned' END AS status FROM {names}", "names")
def _(spark, sf_dir, names):
    sheets = names.select(F.col("k").alias("sheet"))
    return portals.resolve_sheets(sheets, sheets.where("sheet % 5 = 0"), sheets.where("sheet % 3 <> 0"), sheets.where("sheet % 4 <> 0")).select("sheet", "status")


@query("f14_quota", "SELECT k FROM {names} WHERE k <= 15", "names")
def _(spark, sf_dir, names):
    return portals.within_quota(names.where("k <= 15").select("k", F.col("a").alias("filename"))).select("k")


_ZONED = "concat('MDT50CM-', case when k % 4 = 0 then 'REGCAN95' else 'ETRS89' end, '-H', cast(28 + k % 4 as string), '-', c, '.tif')"


@query("m20_zone_systems", "SELECT k, concat('EPSG:', CASE WHEN k % 4 = 0 THEN 4083 ELSE 25828 + k % 4 END) AS crs FROM {names}", "names")
def _(spark, sf_dir, names):
    return names.select("k", portals.zone_system(F.expr(_ZONED)).alias("crs"))


@query("j06_zone_choice", f"WITH n AS (SELECT k % 7 AS region_id, -12.5 + (k % 7) * 4 AS center_x, {_ZONED.replace('as string', 'as varchar')} AS filename, c, 28 + k % 4 AS zone FROM {{names}}), o AS (SELECT *, least(60, greatest(1, floor((center_x + 180) / 6)::int + 1)) AS own FROM n) SELECT region_id, concat('MDT50CM-ZONE-', c, '.TIF') AS sheet, arg_min(filename, (zone <> own, filename)) AS filename FROM o GROUP BY region_id, c", "names")
def _(spark, sf_dir, names):
    return portals.choose_zones(names.select((F.col("k") % 7).alias("region_id"), (-12.5 + (F.col("k") % 7) * 4).alias("center_x"), F.expr(_ZONED).alias("filename")))


@query("c06_portal_products", "SELECT * FROM (VALUES ('cnig', 1, 1), ('copdem', 4, 4), ('pe3d', 1, 6)) t(portal, ready, known)")
def _(spark, sf_dir):
    return portals.products(spark).groupBy("portal").agg(F.count_if("ready").cast("int").alias("ready"), F.count("*").cast("int").alias("known"))


@query("m18_grid_ids", "SELECT k, concat(CASE WHEN k % 2 = 0 THEN 'N' ELSE 'S' END, lpad((k % 90)::varchar, 2, '0'), CASE WHEN k % 3 = 0 THEN 'E' ELSE 'W' END, lpad((k % 180)::varchar, 3, '0')) AS grid_id FROM {names}", "names")
def _(spark, sf_dir, names):
    return names.select("k", portals.grid_id(F.expr("concat('Copernicus_DSM_10_', case when k % 2 = 0 then 'N' else 'S' end, lpad(cast(k % 90 as string), 2, '0'), '_00_', case when k % 3 = 0 then 'E' else 'W' end, lpad(cast(k % 180 as string), 3, '0'), '_00_DEM')")).alias("grid_id"))


@query("w07_link_batches", "SELECT (row_number() OVER (ORDER BY k) - 1) // 100 AS batch, k AS sheet FROM {names}", "names")
def _(spark, sf_dir, names):
    return portals.link_batches(names.select(F.col("k").alias("sheet"), F.col("a").alias("portal_id"))).select("batch", "sheet")


@query("o02_sorted_tiles", "SELECT k, n FROM (SELECT k, row_number() OVER (ORDER BY a, k) AS n FROM {names}) WHERE n <= 100", "names")
def _(spark, sf_dir, names):
    top = names.orderBy("a", "k").limit(100).withColumn("_all", F.lit(1))
    return planning.batches(top.withColumn("_key", F.concat("a", F.lpad(F.col("k").cast("string"), 12, "0"))), "_key", 1, "_all").select("k", (F.col("batch") + 1).alias("n"))


# Published catalogues, as documents made from the tables


@query("s12_item_links", "SELECT DISTINCT concat('https://h/c', n_regionkey, '/index.json') AS collection_url, concat('https://h/c', n_regionkey, '/items/', n_nationkey % 4, '.json') AS item_url FROM nation")
def _(spark, sf_dir):
    link = F.struct(F.lit("item").alias("rel"), F.concat(F.lit("./items/"), (F.col("n_nationkey") % 4).cast("string"), F.lit(".json")).alias("href"))
    own = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(F.struct(F.concat(F.collect_list(link), F.array(F.struct(F.lit("self").alias("rel"), F.lit("x").alias("href")))).alias("links"))).alias("document"))
    return catalogs.stac_item_links(own.select(F.concat(F.lit("https://h/c"), "n_regionkey", F.lit("/index.json")).alias("url"), "document"))


# items of customers: the visual asset is a TIFF for even keys, else another asset is
_ITEM = """concat('{"id": " c', cast(c_custkey as string), ' ", "bbox": [', cast(c_custkey % 100 as string), ', 1, ', cast(c_custkey % 100 + 2 as string), ', 3], "geometry": {"type": "Polygon", "coordinates": []}, "properties": {', case when c_custkey % 3 = 0 then '"start_datetime": "2020", ' else '' end, '"datetime": "2019"}, "assets": {"a": {"href": "./a.json", "type": "application/json"}, "b": {"href": "./b.TIF?x", "type": ""}, "visual": {"href": "./v', cast(c_custkey as string), case when c_custkey % 2 = 0 then '.tiff' else '.png' end, '", "file:checksum": "k"}}}')"""


@query("s13_items", "SELECT concat('c', c_custkey) AS tile_id, (c_custkey % 100)::double AS minx, (c_custkey % 100 + 2)::double AS maxx, CASE WHEN c_custkey % 2 = 0 THEN concat('https://h/i/v', c_custkey, '.tiff') ELSE 'https://h/i/b.TIF?x' END AS url, CASE WHEN c_custkey % 3 = 0 THEN '2020' ELSE '2019' END AS start_datetime, '2019' AS end_datetime, CASE WHEN c_custkey % 2 = 0 THEN 'k' END AS checksum FROM customer")
def _(spark, sf_dir):
    items = table(spark, sf_dir, "customer").select(F.concat(F.lit("https://h/i/"), "c_custkey", F.lit(".json")).alias("item_url"), F.expr(_ITEM).alias("document"))
    return catalogs.stac_items(items).select("tile_id", "minx", "maxx", "url", "start_datetime", "end_datetime", "checksum")


@query("s20_latest_products", "WITH p AS (SELECT s_suppkey AS k, concat('id', j) AS id, CASE WHEN j % 4 = 3 THEN -1 ELSE 2010 + (s_suppkey * j) % 5 END AS y, CASE WHEN j % 4 = 3 THEN -1 ELSE j % 2 END AS n FROM supplier, range(6) r(j)) SELECT k, arg_min(id, (-y, -n, id)) AS product_id FROM p GROUP BY k")
def _(spark, sf_dir):
    version = "case when j % 4 = 3 then 'odd' else concat('x/', cast(2010 + (s_suppkey * j) % 5 as string), '_', cast(j % 2 as string)) end"
    one = f"struct(concat('id', cast(j as string)) as Id, array(struct('other' as Name, 'x' as Value), struct('dataset' as Name, {version} as Value)) as Attributes)"
    searches = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.expr(f"to_json(struct(transform(sequence(0L, 5L), j -> {one}) as value))").alias("document"))
    return catalogs.latest_products(searches, "k")


@query("s21_releases", "SELECT n_nationkey::varchar AS version, make_date(2015, 1 + n_nationkey % 12, 1 + n_nationkey) AS date FROM nation WHERE n_nationkey % 5 <> 0")
def _(spark, sf_dir):
    title = "case when n_nationkey % 5 = 0 then 'no date' else concat('World (', cast(make_date(2015, cast(1 + n_nationkey % 12 as int), cast(1 + n_nationkey as int)) as string), ')') end"
    entry = F.struct(F.col("n_nationkey").cast("string").alias("key"), F.expr(f"named_struct('itemTitle', {title})").alias("value"))
    document = table(spark, sf_dir, "nation").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("document"))
    return catalogs.releases(document)


@query("s30_audits", "SELECT concat('l', o_custkey % 40) AS lpc_link, concat('w', o_orderkey % 7) AS workunit, count(DISTINCT concat('S', o_custkey % 3, '__', o_custkey)) AS targets FROM orders GROUP BY 1, 2")
def _(spark, sf_dir):
    target = F.struct(F.concat(F.lit("S"), (F.col("o_custkey") % 3).cast("string"), F.lit("__"), F.col("o_custkey").cast("string")).alias("region_id"))
    unit = F.struct(F.concat(F.lit("w"), (F.col("o_orderkey") % 7).cast("string")).alias("workunit"), F.concat(F.lit("l"), (F.col("o_custkey") % 40).cast("string")).alias("lpc_link"), F.array(target).alias("targets"))
    documents = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 50).alias("d")).agg(F.to_json(F.collect_list(unit)).alias("document"))
    return catalogs.audits(documents).select("lpc_link", "workunit", F.size("targets").cast("long").alias("targets"))


@query("m21_point_squares", "SELECT c_custkey AS region_id, c_custkey * 10.0 - 250 AS minx, 4000000.0 + c_custkey - 250 AS miny, c_custkey * 10.0 + 250 AS maxx, 4000000.0 + c_custkey + 250 AS maxy FROM customer")
def _(spark, sf_dir):
    points = table(spark, sf_dir, "customer").selectExpr("c_custkey AS region_id", "c_custkey * 10D AS x", "4000000D + c_custkey AS y")
    return regions.point_regions(points, ZONE, 500.0).select("region_id", *boxes.SIDES)


@query("a21_batch_envelopes", "SELECT state, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, count(*) AS regions FROM {regions} GROUP BY state", "regions")
def _(spark, sf_dir, places):
    return regions.batch_envelopes(places, "state")


# Assets, names and addresses


@query("f10_selected_assets", "SELECT p_partkey FROM part WHERE p_size % 4 = 2 AND p_size % 3 IN (0, 1)")
def _(spark, sf_dir):
    kinds, products = (F.element_at(F.array(*map(F.lit, names)), (at + 1).cast("int")) for names, at in ((assets.KINDS, F.col("p_size") % 4), (("dem", "dsm", "dtm"), F.col("p_size") % 3)))
    rows = table(spark, sf_dir, "part").select("p_partkey", kinds.alias("kind"), products.alias("product"))
    checked = rows.withColumn("kind", assets.known(F.col("kind"), assets.KINDS, "kind")).withColumn("product", assets.product_name(F.col("product")))
    return assets.selected(checked, ["dem", "dsm"]).select("p_partkey")


@query("f13_metadata", "SELECT p_partkey, p_type AS workunit, CASE WHEN p_size % 2 = 0 THEN p_brand END AS project, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS facts FROM part")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("workunit"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("project"))
    told = assets.with_facts(rows, "clouds")
    return told.select("p_partkey", F.col("metadata")["workunit"].alias("workunit"), F.col("metadata")["project"].alias("project"), F.size("metadata").alias("facts"))


@query("c07_region_facts", "SELECT c_custkey AS region_id, c_custkey % 2 = 0 AS has_target, false AS has_point, c_custkey % 3 = 0 AS has_shape FROM customer")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("region_id"), F.when(F.col("c_custkey") % 2 == 0, "x.tif").alias("target_path"), F.lit(1).alias("width"), F.lit(1).alias("height"), F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit(1))).alias("polygons"))
    return assets.target_grid(rows)


@query("t11_late_regions", "SELECT o_custkey AS region_id, count(*) AS assets FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 6 = 0) AND o_custkey % 4 <> 0 GROUP BY o_custkey")
def _(spark, sf_dir):
    report = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("region_id"), F.when(F.col("o_orderkey") % 6 == 0, "failed").otherwise("success").alias("status"))
    return assets.late_regions(report, report.where("region_id % 4 = 0"))


@query("n51_cache_names", "SELECT k, concat('a_b', c, '_', md5(concat('https://h/a b', c, '/list.txt'))[1:8]) AS name FROM {names}", "names")
def _(spark, sf_dir, names):
    return names.select("k", text.cache_key(F.concat(F.lit("https://h/a b"), "c", F.lit("/list.txt"))).alias("name"))


@query("n54_tile_addresses", "SELECT k, concat('https://h/', k % 9, '/', c, '/', d) AS url, concat('t_', substr(replace(make_date(2020, 1 + (k % 12)::int, 1 + (k % 28)::int)::varchar, '-', ''), 3, 6), '_z', k % 9, '_x', c, '_y', d, '.jpg') AS filename FROM {names}", "names")
def _(spark, sf_dir, names):
    day = F.make_date(F.lit(2020), (F.col("k") % 12 + 1).cast("int"), (F.col("k") % 28 + 1).cast("int")).cast("string")
    z = (F.col("k") % 9).cast("string")
    url = F.lit("https://h/{z}/{x}/{y}")
    for mark, value in (("{z}", z), ("{x}", F.col("c")), ("{y}", F.col("d"))):
        url = F.replace(url, F.lit(mark), value)
    return names.select("k", url.alias("url"), F.concat(F.lit("t_"), text.date_tag(day), F.lit("_z"), z, F.lit("_x"), "c", F.lit("_y"), "d", F.lit(".jpg")).alias("filename"))


@query("n56_iso_times", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS said FROM events")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.iso_seconds(F.col("ts")).alias("said"))


@query("n59_sheet_codes", "SELECT k, k % 8 <> 7 AS valid FROM {names}", "names")
def _(spark, sf_dir, names):
    odd = F.when(F.col("k") % 8 == 7, F.concat(F.expr(_SHEET), F.lit("X"))).otherwise(F.expr(_SHEET))
    return names.select("k", odd.rlike(portals.SHEET).alias("valid"))


@query("o03_sorted_selection", "SELECT l_partkey % 100 AS tile, string_agg(DISTINCT concat('r', lpad(l_suppkey::varchar, 5, '0')), ',' ORDER BY concat('r', lpad(l_suppkey::varchar, 5, '0'))) AS regions FROM lineitem GROUP BY 1")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("tile"), F.concat(F.lit("r"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("region_id"))
    return rows.groupBy("tile").agg(F.array_join(F.array_sort(F.collect_set("region_id")), ",").alias("regions"))


@query("m01_horizontal_parts", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'EPSG:4326' WHEN 1 THEN 'EPSG:26918' ELSE 'EPSG:3857' END AS horizontal, CASE n_nationkey % 3 WHEN 0 THEN 'EGM2008 height (EPSG:3855)' WHEN 1 THEN 'NAVD88 height (EPSG:5703)' END AS vertical FROM nation")
def _(spark, sf_dir):
    parts = {c: (crs.horizontal(c), crs.vertical(c)) for c in ("EPSG:4326+3855", "EPSG:26918+5703", "EPSG:3857")}
    code = F.element_at(F.array(*map(F.lit, parts)), (F.col("n_nationkey") % 3 + 1).cast("int"))
    known = F.create_map(*(F.lit(v) for c, p in parts.items() for v in (c, p[0])))
    upright = F.create_map(*(F.lit(v) for c, p in parts.items() for v in (c, p[1])))
    return table(spark, sf_dir, "nation").select("n_nationkey", known[code].alias("horizontal"), upright[code].alias("vertical"))


# regions as triangles at their lower left corner against tiles as boxes that hold the corner's quarter
@query("m25_polygon_kit", "WITH t AS (SELECT region_id, maxx - minx AS w, maxy - miny AS h, minx, miny FROM {regions}) SELECT region_id, round(w * h / 2 + w * h / 4 - w * h / 4, 6) AS union_area, round(w * h / 4, 6) AS difference_area, round(minx + w / 3, 6) AS cx, round(miny + h / 3, 6) AS cy, minx AS bx, miny + h AS top FROM t", "regions")
def _(spark, sf_dir, places):
    corner = lambda x, y: F.struct((F.col("minx") + x * (F.col("maxx") - F.col("minx"))).alias("x"), (F.col("miny") + y * (F.col("maxy") - F.col("miny"))).alias("y"))
    shaped = places.withColumn("a", F.array(F.array(corner(0, 0), corner(1, 0), corner(0, 1)))).withColumn("b", F.array(F.array(corner(0, 0), corner(0.5, 0), corner(0.5, 0.5), corner(0, 0.5))))
    found = shaped.withColumn("c", polygons.polygon_centroid("a"))
    side = polygons.bounds("a")
    return found.select("region_id", rounded(polygons.union_area("a", "b")).alias("union_area"), rounded(polygons.difference_area("a", "b")).alias("difference_area"), rounded(F.col("c.x")).alias("cx"), rounded(F.col("c.y")).alias("cy"), side[0].alias("bx"), side[3].alias("top"))
