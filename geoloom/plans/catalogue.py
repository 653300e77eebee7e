"""The registered queries: each operator applied to whole tables, with SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import filenames, grids, text
from geoloom.operators import boxes, ledger, naming, planning, points, rasters
from geoloom.plans import names
from geoloom.plans.fixtures import FIXTURES, fixture, fixture_sql
from geoloom.sources import regions as regions_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None, *fixtures: str) -> Callable:
    """Registers f(spark, sf_dir, *fixture frames). The oracle names fixtures in braces."""

    def register(f: Callable) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(spark, sf_dir, *(fixture(spark, sf_dir, x) for x in fixtures))
        if oracle:
            for x in FIXTURES:
                oracle_text = ORACLE_SQL.get(name, oracle).replace("{" + x + "}", fixture_sql(x))
                ORACLE_SQL[name] = oracle_text
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# Point clouds

RESOLUTION = 5.0


def _grid_sql(product: str) -> str:
    keep = "classification = 2" if product == "dtm" else "classification not in (7, 18)"
    how = "max" if product == "dsm" else "min"
    return f"""
        WITH p AS (SELECT * FROM {{points}} WHERE {keep}),
        e AS (SELECT file_id, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy FROM p GROUP BY file_id),
        s AS (SELECT file_id, minx, maxy, greatest(1, ceil((maxx - minx) / 5.0)::bigint) AS width, greatest(1, ceil((maxy - miny) / 5.0)::bigint) AS height FROM e)
        SELECT p.file_id, least(greatest(trunc((maxy - y) / 5.0)::bigint, 0), height - 1) AS "row", least(greatest(trunc((x - minx) / 5.0)::bigint, 0), width - 1) AS col, {how}(z::float) AS value
        FROM p JOIN s USING (file_id) GROUP BY ALL"""


@query("a01_dsm_grid", _grid_sql("dsm"), "points")
def _(spark, sf_dir, cloud):
    return points.grid(cloud, RESOLUTION, "dsm")


@query("a02_dtm_grid", _grid_sql("dtm"), "points")
def _(spark, sf_dir, cloud):
    return points.grid(cloud, RESOLUTION, "dtm")


@query("a03_cloud_extents", "SELECT file_id, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy, count(*) AS points, greatest(1, ceil((max(x) - min(x)) / 5.0)::bigint) AS width, greatest(1, ceil((max(y) - min(y)) / 5.0)::bigint) AS height FROM {points} WHERE classification NOT IN (7, 18) GROUP BY file_id", "points")
def _(spark, sf_dir, cloud):
    return points.extents(cloud, RESOLUTION, "dsm")


@query("f09_class_filter", "SELECT classification, count(*) FILTER (classification NOT IN (7, 18)) AS surface, count(*) FILTER (classification = 2) AS terrain FROM {points} GROUP BY classification", "points")
def _(spark, sf_dir, cloud):
    return cloud.groupBy("classification").agg(F.count_if(points.product_filter("dsm")).alias("surface"), F.count_if(points.product_filter("dtm")).alias("terrain"))


# Boxes and coverage

CELL = 64.0
_PAIRS = "{regions} l JOIN {tiles} r ON l.minx < r.maxx AND r.minx < l.maxx AND l.miny < r.maxy AND r.miny < l.maxy"


def _sides(regions: DataFrame, tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    return boxes.prefixed(regions, "l_"), boxes.prefixed(tiles, "r_")


def _pairs(regions: DataFrame, tiles: DataFrame) -> DataFrame:
    return boxes.box_join(*_sides(regions, tiles), CELL)


@query("j03_tile_overlap", f"SELECT l.region_id, r.tile_id FROM {_PAIRS}", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    return _pairs(regions.drop("state"), tiles.drop("rank")).select(F.col("l_region_id").alias("region_id"), F.col("r_tile_id").alias("tile_id"))


@query("j01_touching_boxes", "SELECT l.region_id, r.tile_id FROM {regions} l JOIN {tiles} r ON l.minx <= r.maxx AND r.minx <= l.maxx AND l.miny <= r.maxy AND r.miny <= l.maxy", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    return boxes.box_join(boxes.prefixed(regions.drop("state"), "l_"), boxes.prefixed(tiles.drop("rank"), "r_"), CELL, touch=True).select(F.col("l_region_id").alias("region_id"), F.col("r_tile_id").alias("tile_id"))


def _with_rings(frame: DataFrame, side: str) -> DataFrame:
    """Regions as right triangles at their lower left corner, tiles as their boxes."""
    corners = [("minx", "miny"), ("maxx", "miny"), *([("maxx", "maxy")] if side == "r_" else []), ("minx", "maxy")]
    return boxes.prefixed(frame, side).withColumn(f"{side}rings", F.array(F.array(*(F.struct(F.col(side + x).alias("x"), F.col(side + y).alias("y")) for x, y in corners))))


# A triangle shares area with a box if the box's lower left corner, moved into the triangle's box, lies inside the slope.
@query("j05_footprints", f"SELECT l.region_id, r.tile_id FROM {_PAIRS} WHERE (greatest(l.minx, r.minx) - l.minx) / (l.maxx - l.minx) + (greatest(l.miny, r.miny) - l.miny) / (l.maxy - l.miny) < 1 - 1e-9", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    found = boxes.footprint_join(_with_rings(regions, "l_"), _with_rings(tiles, "r_"), CELL)
    return found.where("shared_area > 1e-6").select(F.col("l_region_id").alias("region_id"), F.col("r_tile_id").alias("tile_id"))


_COVERAGE = f"""
    WITH p AS (SELECT l.region_id, l.state, r.tile_id, r.rank, (l.maxx - l.minx) * (l.maxy - l.miny) AS area, greatest(l.minx, r.minx) AS x0, least(l.maxx, r.maxx) AS x1, greatest(l.miny, r.miny) AS y0, least(l.maxy, r.maxy) AS y1 FROM {_PAIRS}),
    xs AS (SELECT region_id, x AS a, lead(x) OVER (PARTITION BY region_id ORDER BY x) AS b FROM (SELECT region_id, x0 AS x FROM p UNION SELECT region_id, x1 FROM p)),
    ys AS (SELECT region_id, y AS a, lead(y) OVER (PARTITION BY region_id ORDER BY y) AS b FROM (SELECT region_id, y0 AS y FROM p UNION SELECT region_id, y1 FROM p)),
    c AS (SELECT p.*, xs.a AS ca, xs.b AS cb, ys.a AS ra, ys.b AS rb FROM p JOIN xs ON xs.region_id = p.region_id AND xs.a >= x0 AND xs.b <= x1 JOIN ys ON ys.region_id = p.region_id AND ys.a >= y0 AND ys.b <= y1),
    m AS (SELECT *, min(rank) OVER (PARTITION BY region_id, ca, ra) AS best FROM c),
    s AS (SELECT region_id, state, tile_id, rank, area, sum(CASE WHEN rank = best THEN (cb - ca) * (rb - ra) ELSE 0 END) AS new_area FROM m GROUP BY ALL),
    u AS (SELECT region_id, sum((cb - ca) * (rb - ra)) AS covered FROM (SELECT DISTINCT region_id, ca, cb, ra, rb FROM c) GROUP BY region_id)"""


@query("j03_newest_first_coverage", f"{_COVERAGE} SELECT region_id, tile_id, rank, round(new_area, 6) AS new_area FROM s WHERE new_area > greatest(area, 1) * 1e-9", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    found = boxes.newest_tiles(*_sides(regions, tiles), CELL)
    return found.select(F.col("l_region_id").alias("region_id"), F.col("r_tile_id").alias("tile_id"), "rank", rounded("new_area").alias("new_area"))


@query("a04_covered_area", f"{_COVERAGE} SELECT r.region_id, round(coalesce(u.covered, 0) / ((r.maxx - r.minx) * (r.maxy - r.miny)), 6) AS ratio FROM {{regions}} r LEFT JOIN u USING (region_id)", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    return _covered(regions, tiles).select(F.col("l_region_id").alias("region_id"), rounded("ratio").alias("ratio"))


def _covered(regions: DataFrame, tiles: DataFrame) -> DataFrame:
    return boxes.covered(*_sides(regions, tiles), CELL)


@query("a19_state_coverage_rollup", f"{_COVERAGE} SELECT r.state, count(*) AS regions, count(*) FILTER (coalesce(u.covered, 0) / ((r.maxx - r.minx) * (r.maxy - r.miny)) >= 1 - 1e-6) AS covered FROM {{regions}} r LEFT JOIN u USING (region_id) GROUP BY ROLLUP (r.state)", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    full = F.col("ratio") >= 1 - 1e-6
    return _covered(regions, tiles).withColumnRenamed("l_state", "state").rollup("state").agg(F.count("*").alias("regions"), F.count_if(full).alias("covered"))


# the union of what the tiles of a rank add: a cell counts for the least rank that covers it, however many of its tiles do
@query("w05_early_close", f"{_COVERAGE}, o AS (SELECT DISTINCT region_id, area, ca, cb, ra, rb, best FROM m), g AS (SELECT region_id, best AS rank, any_value(area) AS area, sum((cb - ca) * (rb - ra)) AS gained FROM o GROUP BY region_id, best), k AS (SELECT *, sum(gained) OVER (PARTITION BY region_id ORDER BY rank) AS so_far FROM g) SELECT p.region_id, min(k.rank) FILTER (so_far >= k.area - 1e-6) AS closed_at, max(p.rank) AS last_rank FROM p LEFT JOIN k ON k.region_id = p.region_id AND k.rank = p.rank GROUP BY p.region_id", "regions", "tiles")
def _(spark, sf_dir, regions, tiles):
    """The first rank at which a region is covered, if it is."""
    return boxes.closed_regions(*_sides(regions, tiles), CELL)


@query("j04_dem_grid_overlap", "WITH g AS (SELECT *, cast(unnest(range(floor(minx / 10)::bigint, ceil(maxx / 10)::bigint)) as bigint) AS gx FROM {regions}), h AS (SELECT *, cast(unnest(range(floor(miny / 10)::bigint, ceil(maxy / 10)::bigint)) as bigint) AS gy FROM g) SELECT gx, gy, count(*) AS regions, min(region_id) AS owner FROM h GROUP BY gx, gy", "regions")
def _(spark, sf_dir, regions):
    """Ten-unit grid cells with their regions; the owner of a shared cell is the least."""
    span = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / 10), F.ceil(F.col(high) / 10) - 1))
    cells = regions.withColumn("gx", span("minx", "maxx")).withColumn("gy", span("miny", "maxy"))
    return cells.groupBy("gx", "gy").agg(F.count("*").alias("regions"), F.min("region_id").alias("owner"))


# Grids

ZOOM = 12
_LAT = f"least(greatest({{0}}, -{grids.MERCATOR_LAT}), {grids.MERCATOR_LAT})"
_TX = f"least(greatest(trunc(({{0}} + 180.0) / 360.0 * {1 << ZOOM})::bigint, 0), {(1 << ZOOM) - 1})"
_TY = f"least(greatest(trunc((1.0 - ln(tan(radians({_LAT})) + 1.0 / cos(radians({_LAT}))) / pi()) / 2.0 * {1 << ZOOM})::bigint, 0), {(1 << ZOOM) - 1})"


@query(
    "j10_xyz_tiles",
    f"WITH r AS (SELECT region_id, {_TX.format('minx + 1e-12')} AS x0, {_TX.format('maxx - 1e-12')} AS x1, {_TY.format('maxy - 1e-12')} AS y0, {_TY.format('miny + 1e-12')} AS y1 FROM {{places}}), x AS (SELECT *, unnest(range(x0, x1 + 1)) AS tile_x FROM r) SELECT region_id, tile_x, unnest(range(y0, y1 + 1)) AS tile_y FROM x",
    "places",
)
def _(spark, sf_dir, places):
    return grids.xyz_cover(places, ZOOM).select("region_id", "tile_x", "tile_y")


@query("m08_tile_bounds", f"WITH t AS (SELECT region_id, {_TX.format('minx')} AS x, {_TY.format('miny')} AS y FROM {{places}}) SELECT region_id, round(x / {1 << ZOOM}.0 * 360 - 180, 6) AS west, round(degrees(atan(sinh(pi() * (1 - 2 * (y + 1) / {1 << ZOOM}.0)))), 6) AS south, round((x + 1) / {1 << ZOOM}.0 * 360 - 180, 6) AS east, round(degrees(atan(sinh(pi() * (1 - 2 * y / {1 << ZOOM}.0)))), 6) AS north FROM t", "places")
def _(spark, sf_dir, places):
    x, y = grids.xyz_tile(F.col("minx"), F.col("miny"), ZOOM)
    at = places.select("region_id", x.alias("x"), y.alias("y"))
    return at.select("region_id", *(rounded(c).alias(n) for c, n in zip(grids.xyz_bounds(ZOOM, F.col("x"), F.col("y")), ("west", "south", "east", "north"), strict=True)))


@query("m08_tile_names", "SELECT k, cast(regexp_extract(n, 'z(\\d+)_x(\\d+)_y(\\d+)', 1) as int) AS z, cast(regexp_extract(n, 'z(\\d+)_x(\\d+)_y(\\d+)', 2) as int) AS x, cast(regexp_extract(n, 'z(\\d+)_x(\\d+)_y(\\d+)', 3) as int) AS y FROM (SELECT k, concat('z12_x', a, '_y00', b, '_google.jpg') AS n FROM {names})", "names")
def _(spark, sf_dir, names):
    named = names.select("k", F.concat(F.lit("z12_x"), "a", F.lit("_y00"), "b", F.lit("_google.jpg")).alias("n"))
    return named.select("k", *(c.alias(n) for c, n in zip(grids.tile_name_parts(F.col("n")), "zxy", strict=True)))


@query("j11_degree_tiles", "WITH y AS (SELECT *, unnest(range(floor(miny)::bigint, ceil(maxy)::bigint)) AS lat FROM {places}), x AS (SELECT *, unnest(range(floor(minx)::bigint, ceil(maxx)::bigint)) AS lon FROM y) SELECT region_id, 'Copernicus_DSM_10_' || CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END || lpad(abs(lat)::varchar, 2, '0') || '_00_' || CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END || lpad(abs(lon)::varchar, 3, '0') || '_00_DEM' AS tile FROM x", "places")
def _(spark, sf_dir, places):
    return grids.degree_cells(places).select("region_id", "tile")


def _sheet_sql(lon: str, lat: str) -> str:
    column, row = f"floor(({lon} + 180.0) / {grids.SHEET_LON})::bigint", f"floor(-({lat}) / {grids.SHEET_LAT})::bigint"
    parts = [f"'S' || chr((65 + {row} // 192)::int)", f"lpad(({column} // 192 + 1)::varchar, 2, '0')"]
    x, y = f"({column} % 192)", f"({row} % 192)"
    for width, height, codes in grids.SHEET_LEVELS:
        flat = "[" + ", ".join(f"'{c}'" for line in codes for c in line) + "]"
        parts.append(f"{flat}[(({y} // {height}) * {len(codes[0])} + {x} // {width} + 1)::int]")
        x, y = f"({x} % {width})", f"({y} % {height})"
    return " || '-' || ".join(parts)


@query("m07_sheet_codes", f"SELECT region_id, {_sheet_sql('minx', 'miny')} AS code FROM {{south}}", "south")
def _(spark, sf_dir, south):
    return south.select("region_id", grids.sheet_code(F.col("minx"), F.col("miny")).alias("code"))


@query(
    "j07_min_fraction",
    f"""WITH r AS (SELECT *, unnest(range(floor(-maxy / {grids.SHEET_LAT})::bigint, ceil(-miny / {grids.SHEET_LAT})::bigint)) AS sheet_row FROM {{south}}),
        c AS (SELECT *, unnest(range(floor((minx + 180.0) / {grids.SHEET_LON})::bigint, ceil((maxx + 180.0) / {grids.SHEET_LON})::bigint)) AS sheet_column FROM r),
        a AS (SELECT *, least(maxx, sheet_column * {grids.SHEET_LON} - 180.0 + {grids.SHEET_LON}) - greatest(minx, sheet_column * {grids.SHEET_LON} - 180.0) AS wide, least(maxy, -sheet_row * {grids.SHEET_LAT}) - greatest(miny, -sheet_row * {grids.SHEET_LAT} - {grids.SHEET_LAT}) AS high FROM c)
        SELECT region_id, sheet_row, sheet_column FROM a WHERE wide > 0 AND high > 0 AND wide * high >= 0.25 * least((maxx - minx) * (maxy - miny), {grids.SHEET_LON * grids.SHEET_LAT})""",
    "south",
)
def _(spark, sf_dir, south):
    return grids.sheet_cover(south, 0.25).select("region_id", "sheet_row", "sheet_column")


@query("m17_projected_grid", "WITH t AS (SELECT k, cast(a as double) * 100 - 530 AS v, cast(c as double) * 1000 + 250 AS w FROM {names}) SELECT k, CASE WHEN abs(v / 4500 - round_even(v / 4500, 0)) <= 1e-9 THEN round_even(v / 4500, 0) ELSE ceil(v / 4500) END * 4500 + 530 AS minx, CASE WHEN abs(v / 4500 - round_even(v / 4500, 0)) <= 1e-9 THEN round_even(v / 4500, 0) ELSE ceil(v / 4500) END * 4500 + 5030 AS maxx, round_even(w / 1500, 0) * 1500 - 750 - 10 AS miny, round_even(w / 1500, 0) * 1500 + 750 + 10 AS maxy FROM t", "names")
def _(spark, sf_dir, names):
    model = {"x": {"scale": 100, "offset": 0, "origin": 530, "ceil": 4500, "floor": 0, "round": 0, "size": 4500, "padding": 0}, "y": {"scale": 1000, "offset": 250, "origin": 0, "ceil": 0, "floor": 0, "round": 1500, "size": 1500, "padding": 10}}
    frame = names.select("k", F.col("a").cast("double").alias("x"), F.col("c").cast("double").alias("y"), *(F.lit(float(v)).alias(f"{axis}_{n}") for axis, own in model.items() for n, v in own.items()), F.lit("min").alias("x_anchor"), F.lit("center").alias("y_anchor"))
    (x0, x1), (y0, y1) = grids.projected_box("x"), grids.projected_box("y")
    return frame.select("k", x0.alias("minx"), x1.alias("maxx"), y0.alias("miny"), y1.alias("maxy"))


@query("m19_utm_dem_tiles", "WITH n AS (SELECT k, concat('USGS_1M_', cast(10 + k % 10 as varchar), '_x', cast(10 + k % 80 as varchar), 'y', c, '_P.tif') AS n FROM {names}) SELECT k, cast(regexp_extract(n, '_(\\d{1,2})_x(\\d+)y(\\d+)', 1) as int) + 32600 AS epsg, cast(regexp_extract(n, '_(\\d{1,2})_x(\\d+)y(\\d+)', 2) as int) * 10000 AS x, (cast(regexp_extract(n, '_(\\d{1,2})_x(\\d+)y(\\d+)', 3) as int) - 1) * 10000 AS y FROM n", "names")
def _(spark, sf_dir, names):
    named = names.select("k", F.concat(F.lit("USGS_1M_"), (10 + F.col("k") % 10).cast("string"), F.lit("_x"), (10 + F.col("k") % 80).cast("string"), F.lit("y"), "c", F.lit("_P.tif")).alias("n"))
    return named.select("k", *(c.alias(n) for c, n in zip(grids.utm_tile(F.col("n")), ("epsg", "x", "y"), strict=True)))


# Names: one query a parser, over names that fit it and names that do not


def _register_parser(parser: str, case: names.Case) -> None:
    @query(f"n_parse_{parser}", names.oracle(case), "names")
    def _(spark, sf_dir, rows):
        return filenames.decode(rows.select("k", F.expr(names.named(case)).alias("filename")), parser)


for _p, _c in names.CASES.items():
    _register_parser(_p, _c)


@query("n_parse_ca_upper_pit_5k", None, "names")  # projections are beyond SQL; the tests lead known corners back
def _(spark, sf_dir, names):
    return filenames.decode(names.select("k", F.expr("concat('USGS_10TFL', c, d, '.laz')").alias("filename")), "ca_upper_pit_5k")


_GRID = {"x_scale": 1000, "y_scale": 1000, "x_offset": 0, "y_offset": 0, "x_anchor": "min", "y_anchor": "max", "width": 1500, "height": 1500}
_CATALOGUE = {"version": 1, "projects": [{"name": "small", "match": {"workunit": "^small"}, "schemes": [{"parser": "axis_pair", "crs": "EPSG:26917", "grid": _GRID}]}, {"name": "green", "match": {"workunit": "^(medium|large)", "project": "green"}, "schemes": [{"parser": "axis_pair", "crs": "workunit", "grid": _GRID}]}]}
_UNITS = "SELECT p_partkey, p_type AS workunit, p_name AS project, CASE WHEN p_size % 3 = 0 THEN '26918' END AS horiz_crs, 1000 + p_partkey % 9000 AS e, 1000 + (p_partkey * 7) % 9000 AS n, p_partkey % 11 = 0 AS odd FROM part"


@query("c11_plan_by_rules", f"WITH u AS ({_UNITS}), r AS (SELECT *, CASE WHEN regexp_matches(workunit, '(?i)^small') THEN 'small' WHEN regexp_matches(workunit, '(?i)^(medium|large)') AND regexp_matches(project, '(?i)green') THEN 'green' END AS rule FROM u), t AS (SELECT *, CASE WHEN odd THEN NULL WHEN rule = 'small' THEN 'EPSG:26917' WHEN rule = 'green' THEN 'EPSG:' || horiz_crs END AS tile_crs FROM r) SELECT p_partkey, rule, tile_crs, CASE WHEN tile_crs IS NOT NULL THEN e * 1000.0::double END AS minx, CASE WHEN tile_crs IS NOT NULL THEN n * 1000.0::double END AS maxy, coalesce(NOT odd AND rule IS NOT NULL AND tile_crs IS NULL, false) AS no_system FROM t")
def _(spark, sf_dir):
    units = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_type AS workunit", "p_name AS project", "cast(null AS string) AS lpc_link", "case when p_size % 3 = 0 then '26918' end AS horiz_crs", "case when p_partkey % 11 = 0 then 'odd.laz' else concat('t_E', cast(1000 + p_partkey % 9000 as string), 'N', cast(1000 + (p_partkey * 7) % 9000 as string), '.laz') end AS filename")
    return naming.plan_tiles(units, naming.parse_rules(_CATALOGUE)).select("p_partkey", "rule", "tile_crs", "minx", "maxy", "no_system")


# Links and documents


@query("n50_url_parts", r"SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) AS source, regexp_replace(replace(url, '://', ':/'), '^(https?):/([^/])', '\1://\2') AS repaired, md5(url)[1:8] AS digest FROM pages")
def _(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", text.url_host(url).alias("host"), text.url_path(url).alias("path"), text.url_query(url, "utm_source").alias("source"), text.normalized_link(F.replace(url, F.lit("://"), F.lit(":/"))).alias("repaired"), F.element_at(F.split(text.cache_key(url), "_"), -1).alias("digest"))


@query("s16_html_links", r"SELECT page_id, link FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]*\shref=" + '"([^"]*)"' + r"', 1)) AS link FROM pages)")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.links(F.col("html"))).alias("link"))


@query("s19_link_prefixes", r"SELECT link, count(*) AS pages FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '<a[^>]*\shref=" + '"([^"]*)"' + r"', 1)) AS link FROM pages) WHERE link IN (SELECT concat('/', r_name) FROM region UNION ALL SELECT '/the' UNION ALL SELECT '/The') GROUP BY link")
def _(spark, sf_dir):
    wanted = table(spark, sf_dir, "region").select(F.concat(F.lit("/"), "r_name").alias("link")).union(spark.createDataFrame([("/the",), ("/The",)], "link string"))
    found = table(spark, sf_dir, "pages").select("page_id", F.explode(text.links(F.col("html"))).alias("link")).distinct()
    return found.join(wanted.distinct(), "link", "left_semi").groupBy("link").agg(F.count("*").alias("pages"))


_PLACEHOLDER = "concat('t_', case k % 4 when 0 then concat(a, '_') when 1 then concat(a, b, '_') when 2 then concat('ABC', a, b, '_') else a end, case when k % 5 = 0 then '_' else '' end, '.laz')"


# a name with no last token of six digits: only those of one kind have it, and a name without a last underscore is none
@query("f08_placeholders", f"SELECT k, {_PLACEHOLDER} AS n, k % 4 IN (0, 2) OR k % 4 = 3 AND k % 5 = 0 AS placeholder FROM {{names}}", "names")
def _(spark, sf_dir, rows):
    return rows.select("k", F.expr(_PLACEHOLDER).alias("n")).withColumn("placeholder", filenames.placeholder(F.col("n")))


@query("f03_extension_filter", "SELECT k, n, lower(regexp_extract(n, '[^.](\\.[^./]*)$', 1)) AS extension, regexp_replace(n, '^(.*?)(\\.[^./]*)?$', '\\1_x\\2') AS suffixed FROM (SELECT k, concat('t_', a, CASE k % 3 WHEN 0 THEN '.TIF' WHEN 1 THEN '.tiff' ELSE '' END) AS n FROM {names})", "names")
def _(spark, sf_dir, names):
    named = names.select("k", F.expr("concat('t_', a, case k % 3 when 0 then '.TIF' when 1 then '.tiff' else '' end)").alias("n"))
    return named.select("k", "n", text.extension(F.col("n")).alias("extension"), text.suffixed(F.col("n"), "x").alias("suffixed"))


@query("x_json_props", "SELECT event_type, count(json_extract(props, '$.k')) AS n, sum(cast(json_extract(props, '$.k') as bigint)) AS total FROM events GROUP BY event_type")
def _(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k).alias("total"))


@query("n55_duration", "WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cast(floor(o_totalprice) as bigint) END AS s FROM orders) SELECT o_orderkey, CASE WHEN s IS NULL THEN 'unknown' ELSE concat(CASE WHEN s >= 86400 THEN concat(s // 86400, 'd ') ELSE '' END, CASE WHEN s >= 3600 THEN concat(lpad((s % 86400 // 3600)::varchar, 2, '0'), 'h ') ELSE '' END, CASE WHEN s >= 60 THEN concat(lpad((s % 3600 // 60)::varchar, 2, '0'), 'm ') ELSE '' END, lpad((s % 60)::varchar, 2, '0'), 's') END AS took FROM s")
def _(spark, sf_dir):
    seconds = F.when(F.col("o_orderkey") % 11 != 0, F.floor("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", ledger.duration(seconds).alias("took"))


# Requests and catalogues


@query("a05_request_dedup", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY ordinal) AS n FROM {requests}) SELECT filename, max(region_id) FILTER (n = 1) AS region_id, min(ordinal) AS ordinal, list_sort(list_distinct(list(region_id))) AS targets, count(*) - 1 AS duplicates FROM r GROUP BY filename", "requests")
def _(spark, sf_dir, requests):
    return planning.dedup_requests(requests.select("filename", "region_id", "ordinal", F.array("region_id").alias("target_region_ids")))


@query("a27_targets_in_order", "SELECT filename, list(region_id ORDER BY o) AS targets FROM (SELECT filename, region_id, min(ordinal) AS o FROM {requests} GROUP BY 1, 2) GROUP BY filename", "requests")
def _(spark, sf_dir, requests):
    return planning.targets_in_order(requests, "filename", "region_id", "ordinal")


@query("a06_latest_per_key", "SELECT l_partkey, max(l_shipdate) AS l_shipdate, min_by(ordinal, ordinal) AS ordinal FROM (SELECT *, l_orderkey * 10 + l_linenumber AS ordinal, max(l_shipdate) OVER (PARTITION BY l_partkey) AS top FROM lineitem) WHERE l_shipdate = top GROUP BY l_partkey")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"))
    return planning.latest(rows, ["l_partkey"], "l_shipdate", "ordinal")


@query("a08_link_dedup_counts", "WITH f AS (SELECT region_id, filename, count(*) AS n, max(arrived) AS real FROM {requests} GROUP BY 1, 2) SELECT region_id, count(*) FILTER (real) AS files, coalesce(sum(n - 1) FILTER (real), 0) AS duplicates, coalesce(sum(n) FILTER (NOT real), 0) AS placeholders FROM f GROUP BY region_id", "requests")
def _(spark, sf_dir, requests):
    return planning.link_counts(requests.select("region_id", "filename", (~F.col("arrived")).alias("placeholder")), "region_id")


@query("a13_conflict_keys", "SELECT p_brand, count(DISTINCT p_size) AS n_values FROM part GROUP BY p_brand HAVING count(DISTINCT p_size) > 1")
def _(spark, sf_dir):
    return planning.conflicts(table(spark, sf_dir, "part"), "p_brand", "p_size")


@query("a24_single_product", "SELECT p_brand, count(DISTINCT p_type) = 1 AS single, min(p_type) AS value FROM part GROUP BY p_brand")
def _(spark, sf_dir):
    return planning.single_value(table(spark, sf_dir, "part"), "p_brand", "p_type")


@query("a14_latest_delivery", "WITH d AS (SELECT k % 100 AS grid, k, CASE WHEN k % 13 = 0 THEN -1 ELSE 2015 + k % 9 END AS year, CASE WHEN k % 13 = 0 THEN -1 ELSE k % 4 END AS number FROM {names}) SELECT grid, k, year, number FROM (SELECT *, row_number() OVER (PARTITION BY grid ORDER BY year DESC, number DESC, k) AS n FROM d) WHERE n = 1", "names")
def _(spark, sf_dir, names):
    named = names.select((F.col("k") % 100).alias("grid"), "k", F.expr("case when k % 13 = 0 then 'x/none' else concat('x/', cast(2015 + k % 9 as string), '_', cast(k % 4 as string)) end").alias("dataset"))
    year, number = planning.delivery_version(F.col("dataset"))
    rows = named.select("grid", "k", year.alias("year"), number.alias("number"))
    return rows.groupBy("grid").agg(F.min_by(F.struct("k", "year", "number"), F.struct(-F.col("year"), -F.col("number"), F.col("k"))).alias("s")).select("grid", "s.*")


@query("a26_zone_alias", "SELECT sheet, zone, filename FROM (SELECT k // 3 AS sheet, 29 + k % 3 AS zone, concat('f', k) AS filename, row_number() OVER (PARTITION BY k // 3 ORDER BY (29 + k % 3 = 30) DESC, concat('f', k)) AS n FROM {names}) WHERE n = 1", "names")
def _(spark, sf_dir, names):
    rows = names.select(F.floor(F.col("k") / 3).alias("sheet"), (29 + F.col("k") % 3).alias("zone"), F.concat(F.lit("f"), F.col("k").cast("string")).alias("filename"))
    return planning.preferred(rows, ["sheet"], F.col("zone") == 30, "filename")


RULES = [("green", {"p_name": "green|lime", "p_type": "STEEL"}), ("small", {"p_type": "^small"}), ("brand", {"p_brand": "#?1[12]$"})]


@query("j02_rule_match", "WITH m AS (SELECT p_partkey, list_filter([CASE WHEN regexp_matches(p_name, '(?i)green|lime') AND regexp_matches(p_type, '(?i)STEEL') THEN 'green' END, CASE WHEN regexp_matches(p_type, '(?i)^small') THEN 'small' END, CASE WHEN regexp_matches(p_brand, '(?i)#?1[12]$') THEN 'brand' END], lambda x: x IS NOT NULL) AS rules FROM part) SELECT p_partkey, rules, len(rules) > 1 AS ambiguous FROM m")
def _(spark, sf_dir):
    return planning.match_rules(table(spark, sf_dir, "part"), RULES).select("p_partkey", "rules", "ambiguous")


@query("c12_first_scheme", "SELECT p_partkey, CASE WHEN regexp_matches(p_type, '(?i)^small') THEN 'small' WHEN regexp_matches(p_brand, '(?i)#?1[12]$') THEN 'brand' END AS scheme FROM part")
def _(spark, sf_dir):
    return planning.match_rules(table(spark, sf_dir, "part"), RULES[1:]).select("p_partkey", F.get("rules", F.lit(0)).alias("scheme"))


@query("j19_nearest_release", "WITH r AS (SELECT DISTINCT cast(l_shipdate as date) AS d FROM lineitem WHERE l_orderkey % 97 = 0), q AS (SELECT o_orderkey, cast(o_orderdate as date) AS wanted FROM orders), a AS (SELECT q.*, r.d AS before FROM q ASOF LEFT JOIN r ON q.wanted >= r.d), b AS (SELECT a.*, r.d AS after FROM a ASOF LEFT JOIN r ON a.wanted <= r.d) SELECT o_orderkey, wanted, CASE WHEN after IS NULL OR wanted - before <= after - wanted THEN before ELSE after END AS release FROM b")
def _(spark, sf_dir):
    releases = table(spark, sf_dir, "lineitem").where("l_orderkey % 97 = 0").select(F.col("l_shipdate").cast("date").alias("d")).distinct()
    requests = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("wanted"))
    return planning.nearest_release(requests, releases, "o_orderkey", "d")


@query("w01_newest_first_order", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY cast(o_orderdate as date)::varchar DESC, o_orderkey) AS rank FROM orders")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return planning.ranked(rows, "d", "o_orderkey", ["o_custkey"]).drop("d")


@query("w07_batches", "SELECT p_partkey, p_brand, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 100 AS batch FROM part")
def _(spark, sf_dir):
    return planning.batches(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey", 100, "p_brand")


@query("w08_first_middle_last", "SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM part) WHERE k IN (1, n // 2 + 1, n)")
def _(spark, sf_dir):
    return planning.first_middle_last(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey", "p_brand")


@query("w06_head_tail", "SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM part) WHERE k <= 17 OR k > n - 3")
def _(spark, sf_dir):
    return planning.head_and_tail(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey", "p_brand")


@query("o04_examples", "WITH d AS (SELECT DISTINCT p_brand, p_name FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) AS k FROM d) SELECT p_brand, list(p_name ORDER BY p_name) FILTER (k <= 10) AS examples, greatest(count(*) - 10, 0) AS more FROM r GROUP BY p_brand")
def _(spark, sf_dir):
    return planning.examples(table(spark, sf_dir, "part"), "p_brand", "p_name")


@query("w10_groups_in_order", "SELECT p_brand, first, n, dense_rank() OVER (ORDER BY first) AS number FROM (SELECT p_brand, min(p_partkey) AS first, count(*) AS n FROM part GROUP BY p_brand)")
def _(spark, sf_dir):
    return planning.groups_in_order(table(spark, sf_dir, "part"), "p_brand", "p_partkey")


@query("w09_priority_subset", "WITH e AS (SELECT o_custkey AS g, -epoch_us(o_orderdate) AS r, unnest([o_orderpriority, o_orderstatus]) AS target FROM orders), f AS (SELECT g, target, min(r) AS r FROM e GROUP BY g, target) SELECT g, r, count(*) AS added FROM f GROUP BY g, r")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), (-F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("r"), F.array("o_orderpriority", "o_orderstatus").alias("targets"))
    return planning.priority_subset(rows, "g", "r", "targets")


@query("a25_unique_ids", "SELECT c_name, count(*) AS n FROM customer GROUP BY c_name HAVING count(*) > 1 UNION ALL SELECT c_mktsegment, count(*) FROM customer GROUP BY c_mktsegment HAVING count(*) > 1")
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    repeated = lambda c: customers.groupBy(F.col(c).alias("c_name")).agg(F.count("*").alias("n")).where("n > 1")
    return repeated("c_name").union(repeated("c_mktsegment"))


@query("f05_attribute_whitelist", "SELECT p_partkey FROM part WHERE trim(p_size::varchar) IN ('1', '2', '3') AND trim(p_brand) IN (SELECT min(p_brand) FROM part UNION ALL SELECT max(p_brand) FROM part)")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    ends = part.agg(F.min("p_brand"), F.max("p_brand")).first()
    return regions_source.included(part, {"p_size": [1, " 2 ", "3"], "p_brand": [f" {b}" for b in ends]}).select("p_partkey")


@query("f07_impossible_degrees", "SELECT c_nationkey, max(abs(maxx)) <= 180 AND max(abs(maxy)) <= 90 AS possible, min(minx) AS minx, max(maxx) AS maxx, min(miny) AS miny, max(maxy) AS maxy FROM {places} JOIN customer ON region_id = c_custkey GROUP BY c_nationkey", "places")
def _(spark, sf_dir, places):
    """The batch envelope of each group and whether it can be degrees."""
    rows = places.join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("region_id"), "c_nationkey"), "region_id")
    possible = (F.max(F.abs("maxx")) <= 180) & (F.max(F.abs("maxy")) <= 90)
    return rows.groupBy("c_nationkey").agg(possible.alias("possible"), F.min("minx").alias("minx"), F.max("maxx").alias("maxx"), F.min("miny").alias("miny"), F.max("maxy").alias("maxy"))


# Ledger and reports


@query("j13_missing_outputs", "SELECT DISTINCT region_id, filename FROM {requests} r WHERE NOT EXISTS (SELECT 1 FROM {requests} p WHERE p.arrived AND p.filename = r.filename)", "requests")
def _(spark, sf_dir, requests):
    return ledger.missing_outputs(requests.select("region_id", "filename").distinct(), requests.where("arrived"), ["filename"]).select("region_id", "filename")


@query("u03_complete_regions", "WITH n AS (SELECT DISTINCT l_orderkey AS region_id, l_partkey AS item, l_partkey % 31 <> 0 AS there FROM lineitem) SELECT region_id, count(*) AS required, count(*) FILTER (there) AS there FROM n GROUP BY region_id HAVING bool_and(there)")
def _(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("region_id"), F.col("l_partkey").alias("item"))
    return ledger.complete_groups(wanted.distinct(), wanted.where("item % 31 <> 0"), "region_id", "item")


@query("u02_pending", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 16 = 0")
def _(spark, sf_dir):
    return ledger.missing_outputs(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").where("o_orderkey % 16 = 0").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("u01_usable_assets", "SELECT status, count(*) AS n FROM (SELECT status FROM {requests} WHERE status = 'success' UNION ALL SELECT status FROM {requests} WHERE status = 'skipped') GROUP BY status", "requests")
def _(spark, sf_dir, requests):
    return requests.where("status = 'success'").unionByName(requests.where("status = 'skipped'")).groupBy("status").agg(F.count("*").alias("n"))


_FIRST = "(SELECT filename, min_by(region_id, ordinal) AS region_id, min_by(status, ordinal) AS status, list_distinct(list(region_id)) AS targets FROM {requests} GROUP BY filename)"


def _files(requests: DataFrame) -> DataFrame:
    return requests.groupBy("filename").agg(F.min_by("region_id", "ordinal").alias("region_id"), F.min_by("status", "ordinal").alias("status"), F.collect_set("region_id").alias("target_region_ids"))


@query("j18_fanout_status", f"WITH f AS {_FIRST}, e AS (SELECT filename, region_id AS owner, unnest(targets) AS region_id, status FROM f) SELECT filename, region_id, CASE WHEN region_id = owner OR status <> 'success' THEN status ELSE 'reused' END AS status FROM e", "requests")
def _(spark, sf_dir, requests):
    return ledger.fan_out(_files(requests))


@query("a09_status_counts", f"WITH f AS {_FIRST}, e AS (SELECT region_id AS owner, unnest(targets) AS region_id, status FROM f), s AS (SELECT region_id, CASE WHEN region_id = owner OR status <> 'success' THEN status ELSE 'reused' END AS status FROM e) SELECT region_id, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'reused') AS reused, count(*) FILTER (status = 'failed') AS failed, count(*) AS total FROM s GROUP BY region_id", "requests")
def _(spark, sf_dir, requests):
    return ledger.status_counts(ledger.fan_out(_files(requests)), "region_id")


@query("a30_region_readiness", "WITH n AS (SELECT DISTINCT region_id, filename, CASE WHEN arrived THEN status END AS status FROM {requests}), c AS (SELECT region_id, count(*) FILTER (status IN ('success', 'skipped')) AS assets, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status IS NULL) AS pending FROM n GROUP BY region_id), d AS (SELECT region_id, bool_and(closed) AS closed FROM {requests} GROUP BY region_id) SELECT region_id, closed, assets, failed, pending, CASE WHEN failed > 0 THEN 'failed' WHEN NOT closed THEN 'open' WHEN pending > 0 THEN 'pending' WHEN assets = 0 THEN 'empty' ELSE 'ready' END AS state FROM c JOIN d USING (region_id)", "requests")
def _(spark, sf_dir, requests):
    needs = requests.select("region_id", "filename", F.when(F.col("arrived"), F.col("status")).alias("status")).distinct()
    return ledger.readiness(needs, requests.where("closed").select("region_id"))


@query("j14_resume_history", "WITH s AS (SELECT event_id, user_id, event_type, value, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS m FROM events) SELECT c.user_id, c.event_type AS state, cast(floor(c.value / 50) as bigint) AS fingerprint, p.event_type AS previous_state, floor(c.value / 50) <> floor(p.value / 50) AS changed FROM s c JOIN s p ON c.user_id = p.user_id AND c.n = 1 AND p.m = 1")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    snapshot = lambda pick: events.groupBy("user_id").agg(pick(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("s")).select("user_id", F.col("s.event_type").alias("state"), F.floor(F.col("s.value") / 50).alias("fingerprint"))
    return ledger.with_history(snapshot(F.max_by), snapshot(F.min_by), "user_id")


@query("t08_latest_state", "SELECT worker, event AS state, n AS events FROM (SELECT worker, event, count(*) OVER (PARTITION BY worker) AS n, row_number() OVER (PARTITION BY worker ORDER BY us DESC, seq DESC) AS k FROM {runs}) WHERE k = 1", "runs")
def _(spark, sf_dir, runs):
    return ledger.latest_state(runs.withColumnRenamed("us", "ts"), "worker")


_DELTA = "CASE event WHEN 'signup' THEN 1 WHEN 'view' THEN 1 WHEN 'purchase' THEN -1 WHEN 'error' THEN -1 ELSE 0 END"


@query("w02_worker_utilisation", f"WITH d AS (SELECT pipeline, us, seq, {_DELTA} AS delta FROM {{runs}}), a AS (SELECT pipeline, sum(delta) OVER w AS active, (lead(us) OVER w - us) / 1e6 AS span FROM d WINDOW w AS (PARTITION BY pipeline ORDER BY us, seq)), b AS (SELECT pipeline, sum(CASE WHEN active > 0 THEN active * span ELSE 0 END) AS work, sum(CASE WHEN active > 0 THEN span ELSE 0 END) AS busy FROM a GROUP BY pipeline) SELECT pipeline, round(busy, 3) AS busy_seconds, CASE WHEN busy > 0 THEN round(work / busy, 3) END AS average_active FROM b", "runs")
def _(spark, sf_dir, runs):
    return ledger.utilisation(runs.select("pipeline", "us", "seq", F.expr(_DELTA).alias("delta")), "pipeline")


@query("w03_milestones", "WITH d AS (SELECT pipeline, seq, row_number() OVER (PARTITION BY pipeline ORDER BY seq) AS done, count(*) OVER (PARTITION BY pipeline) AS total FROM {runs}), s AS (SELECT *, done * 10 // total AS step FROM d), l AS (SELECT *, lag(step, 1, 0) OVER (PARTITION BY pipeline ORDER BY seq) AS before FROM s) SELECT pipeline, seq, done, step FROM l WHERE step > before", "runs")
def _(spark, sf_dir, runs):
    from pyspark.sql import Window

    return ledger.milestones(runs.select("pipeline", "seq"), "pipeline", F.count("*").over(Window.partitionBy("pipeline")))


@query("a10_run_summary", "SELECT pipeline, count(*) AS events, count(*) FILTER (event = 'error') AS errors, count(DISTINCT worker) AS workers, round(sum(amount), 4) AS amount, min(us) AS began, max(us) AS ended FROM {runs} GROUP BY pipeline", "runs")
def _(spark, sf_dir, runs):
    return runs.groupBy("pipeline").agg(F.count("*").alias("events"), F.count_if(F.col("event") == "error").alias("errors"), F.count_distinct("worker").alias("workers"), rounded(F.sum("amount"), 4).alias("amount"), F.min("us").alias("began"), F.max("us").alias("ended"))


@query("a12_eta", "WITH s AS (SELECT pipeline, count(*) FILTER (event IN ('purchase', 'signup')) AS done, count(*) AS total, (max(us) - min(us)) / 1e6 AS seconds FROM {runs} GROUP BY pipeline) SELECT pipeline, done, total, CASE WHEN seconds > 0 THEN round(done / seconds, 9) END AS rate, CASE WHEN done > 0 AND seconds > 0 THEN round((total - done) / (done / seconds), 3) END AS left_seconds FROM s", "runs")
def _(spark, sf_dir, runs):
    s = runs.groupBy("pipeline").agg(F.count_if(F.col("event").isin("purchase", "signup")).alias("done"), F.count("*").alias("total"), ((F.max("us") - F.min("us")).cast("double") / 1e6).alias("seconds"))
    speed, left = ledger.rate(F.col("done"), F.col("total"), F.col("seconds"))
    return s.select("pipeline", "done", "total", rounded(speed, 9).alias("rate"), rounded(left, 3).alias("left_seconds"))


@query("a18_audit_status", "SELECT l_suppkey, CASE WHEN sum(cast(l_returnflag = 'R' as int)) = 0 THEN 'unmatched' WHEN sum(cast(l_returnflag = 'R' as int)) = count(*) THEN 'matched' ELSE 'partial' END AS status, count(*) AS files FROM lineitem GROUP BY l_suppkey")
def _(spark, sf_dir):
    parsed = F.count_if(F.col("l_returnflag") == "R")
    status = F.when(parsed == 0, "unmatched").when(parsed == F.count("*"), "matched").otherwise("partial")
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(status.alias("status"), F.count("*").alias("files"))


@query("j08_missing_in_catalogue", "SELECT p.p_partkey, 'not in catalogue' AS error FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey AND l.l_quantity > 45 WHERE l.l_partkey IS NULL")
def _(spark, sf_dir):
    listed = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return ledger.missing_outputs(table(spark, sf_dir, "part").select("p_partkey"), listed, ["p_partkey"]).withColumn("error", F.lit("not in catalogue"))


@query("j12_region_lookup", "SELECT n_name, r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name")
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "r_name", "customers")


# Rasters

_CELLS = "(SELECT raster_id, \"row\", col, min_by(v, ordinal) AS value FROM (SELECT *, coalesce(value, -1) AS v FROM {cells}) GROUP BY 1, 2, 3)"
_VALUES = f"(SELECT raster_id, \"row\", col, CASE WHEN value >= 0 THEN value END AS value FROM {_CELLS})"


def _cells(cells: DataFrame) -> DataFrame:
    """The first record of each cell, void or not."""
    first = F.min_by(F.coalesce("value", F.lit(-1.0)), "ordinal")
    return cells.groupBy("raster_id", "row", "col").agg(first.alias("value")).withColumn("value", F.when(F.col("value") >= 0, F.col("value")))


for _method, _pick in (("first", "min_by"), ("last", "max_by")):

    @query(f"a22_mosaic_{_method}", f"SELECT \"row\", col, {_pick}(value, raster_id) AS value FROM {_VALUES} WHERE value IS NOT NULL GROUP BY \"row\", col", "cells")
    def _(spark, sf_dir, cells, method=_method):
        return rasters.mosaic(_cells(cells), "raster_id", method)


_REDUCERS = {"average": "avg(value)", "min": "min(value)", "max": "max(value)", "med": "quantile_cont(value, 0.5)", "q1": "quantile_cont(value, 0.25)", "q3": "quantile_cont(value, 0.75)", "sum": "sum(value)", "rms": "sqrt(avg(value * value))"}
_COARSE = 'raster_id, "row" // 4 AS "row", col // 4 AS col'
for _method in rasters.REDUCERS:
    if _method == "nearest":
        _sql = f'SELECT {_COARSE}, value FROM {_VALUES} WHERE value IS NOT NULL AND "row" % 4 = 2 AND col % 4 = 2'
    elif _method == "mode":
        _sql = f'WITH c AS (SELECT {_COARSE}, value, count(*) AS n FROM {_VALUES} WHERE value IS NOT NULL GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY raster_id, "row", col ORDER BY n DESC, value) AS o FROM c) SELECT raster_id, "row", col, value FROM k WHERE o = 1'
    else:
        _sql = f"SELECT {_COARSE}, round({_REDUCERS[_method]}, 6) AS value FROM {_VALUES} WHERE value IS NOT NULL GROUP BY ALL"

    @query(f"a23_resample_{_method}", _sql, "cells")
    def _(spark, sf_dir, cells, method=_method):
        return rasters.reduce_by(_cells(cells), 4, method).withColumn("value", rounded("value"))


@query("r02_bilinear", f'WITH t AS (SELECT raster_id, "row", col, "row" * 1.5 + 0.75 AS at_row, col * 1.5 + 0.75 AS at_col FROM {_CELLS} WHERE "row" < 30 AND col < 25), n AS (SELECT t.*, floor(at_row - 0.5) + dr AS r, floor(at_col - 0.5) + dc AS c FROM t, (VALUES (0), (1)) a(dr), (VALUES (0), (1)) b(dc)), w AS (SELECT n.raster_id, n."row", n.col, v.value, greatest(1 - abs(at_row - 0.5 - r), 0) * greatest(1 - abs(at_col - 0.5 - c), 0) AS w FROM n JOIN {_VALUES} v ON v.raster_id = n.raster_id AND v."row" = r AND v.col = c WHERE v.value IS NOT NULL) SELECT raster_id, "row", col, round(sum(w * value) / sum(w), 4) AS value FROM w GROUP BY ALL HAVING sum(w) <> 0', "cells")
def _(spark, sf_dir, cells):
    grid = _cells(cells)
    targets = grid.where('row < 30 and col < 25').select("raster_id", "row", "col", (F.col("row") * 1.5 + 0.75).alias("at_row"), (F.col("col") * 1.5 + 0.75).alias("at_col"))
    return rasters.resample(targets, grid, "bilinear").withColumn("value", rounded("value", 4))


_FILLED = f'WITH u AS (SELECT * FROM {_VALUES} WHERE raster_id = 1), b AS (SELECT "row", col, value AS base FROM {_VALUES} WHERE raster_id = 0), f AS (SELECT raster_id, "row", col, coalesce(value, base) AS value, value IS NULL AND base IS NOT NULL AS filled FROM u JOIN b USING ("row", col))'


def _filled(cells: DataFrame) -> DataFrame:
    grid = _cells(cells)
    return rasters.void_fill(grid.where("raster_id = 1"), grid.where("raster_id = 0").withColumn("raster_id", F.lit(1)))


@query("r06_void_fill", f"{_FILLED} SELECT * FROM f", "cells")
def _(spark, sf_dir, cells):
    return _filled(cells)


@query("a20_fill_stats", f"{_FILLED} SELECT raster_id, count(*) AS total, count(*) FILTER (filled) AS n_filled, count(*) FILTER (value IS NULL) AS unfilled, round(count(*) FILTER (filled) / count(*), 6) AS share FROM f GROUP BY raster_id", "cells")
def _(spark, sf_dir, cells):
    return rasters.fill_stats(_filled(cells)).withColumn("share", rounded("share"))


@query("a20_fill_summary", 'WITH f AS (SELECT raster_id % 2 AS folder, raster_id, "row" % 3 = 0 AND value IS NOT NULL AS filled FROM {cells}), r AS (SELECT folder, raster_id, count(*) AS total, count(*) FILTER (filled) AS n FROM f GROUP BY ALL) SELECT folder, count(*) AS rasters, round(avg(n / total), 6) AS mean_share, round(sum(n) / sum(total), 6) AS overall_share FROM r GROUP BY folder', "cells")
def _(spark, sf_dir, cells):
    filled = cells.select((F.col("raster_id") % 2).alias("folder"), "raster_id", ((F.col("row") % 3 == 0) & F.col("value").isNotNull()).alias("filled"))
    return rasters.fill_summary(filled, "folder").select("folder", "rasters", rounded("mean_share").alias("mean_share"), rounded("overall_share").alias("overall_share"))


_WINDOWS = "(SELECT c_custkey AS window_id, cast(c_custkey % 3 as int) AS raster_id, cast(round_even((c_custkey * 7) % 40 / 1.0 - round_even(8 / 1.0, 0) / 2, 0) as int) AS row0, cast(round_even((c_custkey * 5) % 30 / 1.0 - round_even(8 / 1.0, 0) / 2, 0) as int) AS col0, 8 AS height, 8 AS width FROM customer)"


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("window_id"), (F.col("c_custkey") % 3).cast("int").alias("raster_id"))
    row0, height = rasters.point_window(0.0, F.lit(1.0), 8.0, (F.col("window_id") * 7 % 40).cast("double"))
    col0, width = rasters.point_window(0.0, F.lit(1.0), 8.0, (F.col("window_id") * 5 % 30).cast("double"))
    return rows.select("window_id", "raster_id", row0.alias("row0"), col0.alias("col0"), height.alias("height"), width.alias("width"))


@query("r04_native_window", f'SELECT window_id, "row" - row0 AS "row", col - col0 AS col, value FROM {_VALUES} JOIN {_WINDOWS} w USING (raster_id) WHERE "row" >= row0 AND col >= col0 AND "row" < row0 + 8 AND col < col0 + 8', "cells")
def _(spark, sf_dir, cells):
    return rasters.window_cells(_cells(cells), _windows(spark, sf_dir).drop("ordinal")).select("window_id", "row", "col", "value")


@query("a16_valid_fraction", f'WITH v AS (SELECT window_id, count(value) AS n FROM {_VALUES} JOIN {_WINDOWS} w USING (raster_id) WHERE "row" >= row0 AND col >= col0 AND "row" < row0 + 8 AND col < col0 + 8 GROUP BY window_id) SELECT w.window_id, round(coalesce(n, 0) / 64, 6) AS fraction, coalesce(n, 0) / 64 >= 0.5 - 1e-12 AS enough FROM {_WINDOWS} w LEFT JOIN v USING (window_id)', "cells")
def _(spark, sf_dir, cells):
    windows = _windows(spark, sf_dir)
    return rasters.valid_fraction(rasters.window_cells(_cells(cells), windows), windows, 0.5).withColumn("fraction", rounded("fraction"))


@query("f11_valid_mask", "SELECT raster_id, count(*) AS cells, count(CASE WHEN value <> 1000 THEN value END) AS valid FROM {cells} GROUP BY raster_id", "cells")
def _(spark, sf_dir, cells):
    return cells.groupBy("raster_id").agg(F.count("*").alias("cells"), F.count(rasters.valid(F.col("value"), 1000.0)).alias("valid"))


@query("w04_capped_fill", None, "cells")
def _(spark, sf_dir, cells):
    """Sources are lines of the raster; each offers the cells below it to the window of its raster."""
    own = F.col("row") * 40 + F.col("col")
    offers = cells.groupBy(F.col("raster_id").cast("long").alias("window_id"), F.col("row").cast("int").alias("rank")).agg(F.collect_set(own).alias("cells"))
    native = cells.where("value is not null and row < 4").groupBy(F.col("raster_id").cast("long").alias("window_id")).agg(F.collect_set(own).alias("native"))
    return rasters.capped_fill(offers.join(native, "window_id").withColumn("total", F.lit(48 * 40)), 0.9, 0.25)


@query("m04_polygon_area", None, "regions")
def _(spark, sf_dir, regions):
    """Triangles below the diagonal of each region's box, and what they share with the box's inner half."""
    from geoloom.functions.polygons import polygon_area, shared_area

    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x0, y0, x1, y1 = (F.col(c) for c in boxes.SIDES)
    half = (x0 + x1) / 2
    triangle = F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1)))
    left = F.array(F.array(p(x0, y0), p(half, y0), p(half, y1), p(x0, y1)))
    return regions.select("region_id", polygon_area(triangle).alias("area"), shared_area(triangle, left).alias("shared"))


ORACLE_SQL["m04_polygon_area"] = f"SELECT region_id, (maxx - minx) * (maxy - miny) / 2 AS area, (maxx - minx) * (maxy - miny) / 8 AS shared FROM {fixture_sql('regions')}"
