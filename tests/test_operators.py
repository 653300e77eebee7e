"""Known results of the geospatial operators, sources and the streaming ledger."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import crs, grids, polygons
from geoloom.operators import boxes, ledger, points, rasters
from geoloom.sources import geotiff, las, regions, units
from geoloom.streaming import ledger as stream


def cloud(spark, rows):
    return spark.createDataFrame([("f", *r) for r in rows], "file_id string, x double, y double, z double, classification int")


def cells(frame):
    return {(r["row"], r["col"]): r["value"] for r in frame.collect()}


def test_point_grids(spark):
    rows = cloud(spark, [(10.0, 20.0, 1.0, 2), (11.1, 21.1, 2.0, 2), (12.4, 22.4, 3.0, 2)])
    assert cells(points.grid(rows, 1.0)) == {(0, 2): 3.0, (1, 1): 2.0, (2, 0): 1.0}
    assert cells(points.grid(cloud(spark, [(10.0, 20.0, 3.0, 2)]), 2.0)) == {(0, 0): 3.0}
    noisy = cloud(spark, [(0.0, 0.0, 3.0, 2), (0.0, 0.0, 9.0, 7)])
    assert cells(points.grid(noisy, 1.0)) == {(0, 0): 3.0}
    assert cells(points.grid(noisy, 1.0, excluded=())) == {(0, 0): 9.0}
    assert points.grid(rows.where("false"), 1.0).count() == 0


def test_coverage_equals_a_greedy_loop(spark):
    rng = np.random.default_rng(3)
    corners = rng.integers(0, 12, (30, 2))
    tiles = [(k, float(x), float(y), float(x + rng.integers(2, 7)), float(y + rng.integers(2, 7)), int(k)) for k, (x, y) in enumerate(corners.tolist())]
    left = boxes.prefixed(spark.createDataFrame([("r", 1.0, 1.0, 14.0, 14.0)], "region_id string, minx double, miny double, maxx double, maxy double"), "l_")
    right = boxes.prefixed(spark.createDataFrame(tiles, "tile_id int, minx double, miny double, maxx double, maxy double, rank int"), "r_")
    found = boxes.newest_first(boxes.box_join(left, right, 5.0).withColumn("rank", F.col("r_rank")))
    got = {r["r_tile_id"]: r["new_area"] for r in found.where("selected").collect()}
    covered, want = set(), {}
    for k, x0, y0, x1, y1, _ in tiles:
        own = {(x, y) for x in range(max(1, int(x0)), min(14, int(x1))) for y in range(max(1, int(y0)), min(14, int(y1)))}
        if own - covered:
            want[k] = float(len(own - covered))
            covered |= own
    assert got == want


def test_coverage_by_kinds_of_regions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    sides = "minx double, miny double, maxx double, maxy double"
    corners = rng.integers(0, 9, (16, 2))
    drawn = [tuple(map(float, b)) for b in np.hstack([corners, corners + rng.integers(2, 6, (16, 2))]).tolist()]
    areas, spots = drawn[:4], drawn[4:]
    regions = [(k, *areas[k % 4]) for k in range(40)] + [(40, 90.0, 90.0, 91.0, 91.0), (41, *areas[0]), (41, *areas[1])]
    tiles = [(k, *spots[k % 12], k // 12 + k % 3) for k in range(72)] + [(5, *spots[5], 2)]
    left, right = boxes.prefixed(spark.createDataFrame(regions, f"region_id int, {sides}"), "l_"), boxes.prefixed(spark.createDataFrame(tiles, f"tile_id int, {sides}, rank int"), "r_")
    plain = boxes.newest_first(boxes.box_join(left, right, 5.0).withColumn("rank", F.col("r_rank"))).where("l_region_id < 41").cache()
    every = lambda frame, *names: sorted(tuple(r[n] for n in names) for r in frame.collect())
    swept, sweep = [], boxes.newest_first
    monkeypatch.setattr(boxes, "newest_first", lambda pairs, *a: swept.append(pairs.count()) or sweep(pairs, *a))
    ones = left.where("l_region_id < 41")
    columns = ("l_region_id", "r_tile_id", "rank", "new_area")
    assert every(boxes.newest_tiles(ones, right, 5.0), *columns) == every(plain.where("selected"), *columns)
    assert every(boxes.covered(ones, right, 5.0), "l_region_id", "ratio") == every(boxes.coverage(plain, ones), "l_region_id", "ratio")
    closed = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    assert closed(boxes.closed_regions(ones, right, 5.0)) == closed(boxes.early_close(plain))
    assert max(swept) <= 4 * 12  # kinds of regions by boxes of tiles
    cells_of = [{(x, y) for x in range(int(a[0]), int(a[2])) for y in range(int(a[1]), int(a[3]))} for a in (*spots, areas[0], areas[1])]
    union = len((cells_of[12] | cells_of[13]) & set().union(*cells_of[:12]))  # the boxes of one region count together
    assert every(boxes.covered(left.where("l_region_id = 41"), right, 5.0), "covered") == [(float(union),)] * 2


def test_units_meet_kinds_of_regions(spark, monkeypatch):
    regions = spark.range(40).selectExpr("if(id = 3, null, id) AS region_id", "cast(id % 2 * 9 as double) AS minx", "0e0 AS miny", "2e0 + id % 2 * 9 AS maxx", "2e0 AS maxy")
    work = spark.range(60).selectExpr("id % 4 AS unit", "2e0 + id % 4 AS minx", "2e0 AS miny", "9e0 AS maxx", "3e0 AS maxy")
    met, join = [], boxes.box_join
    monkeypatch.setattr(boxes, "box_join", lambda *a, **k: met.append(join(*a, **k).count()) or join(*a, **k))
    got = sorted((str(r["region_id"]), r["unit"]) for r in units.units_of_regions(regions, work, 4.0).collect())
    assert got == sorted((str(None if k == 3 else k), u) for k in range(40) for u in range(4) if k % 2 or u == 0)
    assert sum(met) == 5  # two kinds of regions; one touches a unit, the other all four
    assert sorted(tuple(r) for r in units.unit_targets(regions, work, 4.0).collect()) == [(0, 39), (1, 19), (2, 19), (3, 19)]


def test_equal_boxes_are_compared_once(spark, monkeypatch):
    dealt, cells_of = [], boxes._cells
    monkeypatch.setattr(boxes, "_cells", lambda frame, *a: dealt.append(frame.count()) or cells_of(frame, *a))
    monkeypatch.setattr(boxes, "BUNDLE", 7, raising=False)
    left = boxes.prefixed(spark.range(40).selectExpr("if(id = 3, null, id) AS region_id", "cast(id % 2 as double) AS minx", "-0e0 AS miny", "2e0 + id % 2 AS maxx", "2e0 AS maxy"), "l_")
    right = boxes.prefixed(spark.range(60).selectExpr("id AS tile_id", "id % 5 AS rank", "2e0 AS minx", "1e0 AS miny", "4e0 AS maxx", "if(id = 9, null, 3e0) AS maxy"), "r_")
    rows = boxes.box_join(left, right, 1.5)
    assert rows.columns == [*left.columns, *right.columns]
    got = sorted((str(r["l_region_id"]), r["r_tile_id"], r["r_rank"]) for r in rows.collect())
    assert got == sorted((str(None if k == 3 else k), t, t % 5) for k in range(1, 40, 2) for t in range(60) if t != 9)
    assert sum(dealt) <= 6 + 10  # 20 rows of each of two boxes and 59 of one, in lots of 7
    sides = [f"r_{s}" for s in boxes.SIDES]
    assert boxes.box_join(left, right.select(*sides), 1.5).count() == len(got)


def test_sheet_codes_and_tiles(spark):
    rows = spark.createDataFrame([(-37.2968741, -8.5520857), (-37.2968718, -8.5729191), (-35.2031259, -8.3229169), (10.0, 5.0)], "x double, y double")
    assert [r[0] for r in rows.select(grids.sheet_code(F.col("x"), F.col("y"))).collect()] == ["SC-24-X-B-IV-1-NE-D-I", "SC-24-X-B-IV-1-NE-D-III", "SC-25-V-A-II-4-NO-C-IV", None]
    box = regions.named_boxes(spark, [111.0, 41.0, 112.0, 42.0], "EPSG:4326")
    assert [r["tile"] for r in grids.degree_cells(box).collect()] == ["Copernicus_DSM_10_N41_00_E111_00_DEM"]
    island = regions.named_boxes(spark, [-157.0442776, 21.1503038, -157.0405956, 21.1543840], "EPSG:4326")
    assert grids.xyz_cover(island, 18).count() == 16
    with pytest.raises(ValueError):
        regions.named_boxes(spark, [0.0, 0.0, math.nan, 1.0], "EPSG:4326")


def test_coordinate_systems():
    box = crs.transform_bounds((599849.999972, 4218950.000052, 600297.999972, 4219398.000052), "EPSG:26912", "EPSG:4326")
    assert [round(v, 6) for v in box] == [-109.860992, 38.112812, -109.855819, 38.116899]
    for code, lon, lat in (("EPSG:5070", -100.0, 40.0), ("EPSG:6416", -121.0, 41.0), ("EPSG:2263", -73.9, 40.7), ("EPSG:3424", -74.2, 40.1), ("EPSG:31984", -37.3, -8.55), ("EPSG:3857", 12.0, 50.0)):
        x, y = crs.transform(lon, lat, "EPSG:4326", code)
        assert np.allclose(crs.transform(x, y, code, "EPSG:4326"), (lon, lat), atol=1e-9)
    x, y = crs.transform(-73.9, 40.7, "EPSG:4326", "EPSG:2263")
    assert 950000 < x < 1100000 and 150000 < y < 300000
    west, south, east, north = crs.point_window(-39.9, -8.2, "EPSG:4326", 500)
    flat = crs.transform_bounds((west, south, east, north), "EPSG:4326", "EPSG:31984")
    assert abs(flat[2] - flat[0] - 500) < 2 and abs(flat[3] - flat[1] - 500) < 2
    assert crs.point_window(1000000, 200000, "EPSG:2263", 500)[2] - 1000000 == pytest.approx(250 / crs.US_FOOT)
    with pytest.raises(ValueError):
        crs.system("EPSG:1")


def test_polygons():
    ell = [[(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)]]
    assert polygons.area(ell) == 7 and polygons.intersection_area(ell, [polygons.box_ring(0, 0, 9, 9)]) == pytest.approx(7)
    assert polygons.intersection_area(ell, [polygons.box_ring(0.5, 0.5, 3, 3)]) == pytest.approx(2.25)
    hole = [polygons.box_ring(0, 0, 4, 4), polygons.box_ring(1, 1, 2, 2)]
    assert polygons.area(hole) == 15 and polygons.intersection_area(hole, [polygons.box_ring(0, 0, 2, 2)]) == pytest.approx(3)
    assert polygons.centroid([polygons.box_ring(0, 0, 4, 2)]) == (2, 1)


def test_rasters(spark):
    grid = spark.createDataFrame([(0, k // 4, k % 4, float(k)) for k in range(16)], "raster_id int, row int, col int, value double")
    assert cells(rasters.reduce_by(grid, 2, "average")) == {(0, 0): 2.5, (0, 1): 4.5, (1, 0): 10.5, (1, 1): 12.5}
    halves = spark.createDataFrame([(k, 0, c, float(k + 1) if (c < 2) == (k == 0) else None) for k in range(2) for c in range(4)], "raster_id int, row int, col int, value double")
    assert [v for _, v in sorted(cells(rasters.mosaic(halves, "raster_id")).items())] == [1, 1, 2, 2]
    same = grid.select("raster_id", "row", "col", (F.col("row") + 0.5).alias("at_row"), (F.col("col") + 0.5).alias("at_col"))
    for method in ("bilinear", "cubic", "lanczos"):
        got = cells(rasters.resample(same, grid, method))
        assert all(got[k] == pytest.approx(v) for k, v in cells(grid).items())
    assert rasters.mismatch((1, 0, 0, 0, -1, 0), (1.001, 0, 0, 0, -1, 0)) == pytest.approx(0.001)
    offers = spark.createDataFrame([(1, 0, [1, 2, 3, 4], [0], 10), (1, 1, [1, 2], [0], 10), (1, 2, [3], [0], 10)], "window_id long, rank int, cells array<int>, native array<int>, total int")
    assert [(r["rank"], r["taken"]) for r in rasters.capped_fill(offers, 0.4, 0.3).orderBy("rank").collect()] == [(1, 2), (2, 1)]


def test_utilisation_and_fan_out(spark):
    events = spark.createDataFrame([(1, 0, 1, 1), (1, 1_000_000, 2, 1), (1, 3_000_000, 3, -1), (1, 5_000_000, 4, -1)], "g int, us long, seq int, delta int")
    row = ledger.utilisation(events, "g").first()
    assert (row["busy_seconds"], row["average_active"]) == (5.0, 1.4)
    files = spark.createDataFrame([("f", "0", ["0", "1"], "success")], "filename string, region_id string, target_region_ids array<string>, status string")
    assert {r["region_id"]: r["status"] for r in ledger.fan_out(files).collect()} == {"0": "success", "1": "reused"}
    assert [r[0] for r in spark.range(1).select(ledger.duration(F.lit(93784.0)), ).collect()] == ["1d 02h 03m 04s"]


def test_las_and_geotiff(spark, tmp_path):
    x = np.round(np.linspace(0, 50, 1001), 3)
    las.write_las(str(tmp_path / "a.las"), x, x + 1, x * 2, np.arange(1001) % 20)
    spark.dataSource.register(las.LasSource)
    got = spark.read.format("las").option("pointsPerPartition", "300").load(str(tmp_path / "*.las")).orderBy("x").toPandas()
    assert np.allclose(got.x, x) and np.allclose(got.z, x * 2) and got.classification.tolist() == (np.arange(1001) % 20).tolist()
    values = np.arange(300 * 270, dtype=np.float32).reshape(300, 270)
    values[5, 7] = np.nan
    geotiff.write_geotiff(str(tmp_path / "r.tif"), values, 10.0, 20.0, 0.5)
    spark.dataSource.register(geotiff.GeoTiffSource)
    frame = spark.read.format("geotiff_cells").load(str(tmp_path / "*.tif"))
    back = {(r["row"], r["col"]): r["value"] for r in frame.collect()}
    assert len(back) == values.size and back[5, 7] is None and back[299, 269] == values[299, 269]
    with pytest.raises(ValueError):
        las.read_header(str(tmp_path / "r.tif"))


def test_geojson(spark, tmp_path):
    path = tmp_path / "p.geojson"
    path.write_text('{"features": [{"properties": {"ID": "7"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [0, 2]]]}}]}')
    row = regions.geojson_polygons(spark, str(path), "ID").select("*", polygons.polygon_area("rings").alias("area")).first()
    assert (row["region_id"], row["maxx"], row["area"]) == ("7", 2.0, 2.0)


def test_streaming_ledger_publishes_once(spark, tmp_path):
    source, out = tmp_path / "in", []
    batches = [
        [("a", 1, "need", "f1"), ("b", 2, "need", "f1"), ("b", 3, "need", "f2"), ("a", 4, "done", "f1"), ("b", 5, "done", "f1")],
        [("a", 6, "closed", None), ("b", 7, "closed", None), ("c", 8, "closed", None)],
        [("b", 9, "failed", "f2"), ("a", 10, "done", "f1")],
    ]
    events = spark.readStream.schema(stream.EVENTS).parquet(str(source)) if source.mkdir() is None else None
    query = stream.publish(events).writeStream.foreachBatch(lambda frame, _: out.extend(map(tuple, frame.collect()))).option("checkpointLocation", str(tmp_path / "ckpt")).start()
    for rows in batches:
        spark.createDataFrame(rows, stream.EVENTS).coalesce(1).write.mode("append").parquet(str(source))
        query.processAllAvailable()
    query.stop()
    assert sorted(out) == [("a", "ready", 1), ("b", "failed", 1), ("c", "empty", 0)]
