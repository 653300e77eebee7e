"""Work units, portals, alignment, the run's record and ready components, over local files and answers made here."""

import http.server
import json
import os
import sqlite3
import struct
import threading
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom import components, ready
from geoloom.functions import crs
from geoloom.operators import alignment, runstate
from geoloom.sources import download, geotiff, las, portals, rasters, regions, units

RULES = """
version: 1
projects:
  - name: all
    match: {workunit: "^u"}
    schemes:
      - {parser: axis_pair, crs: "EPSG:4326", grid: {x_scale: 1, y_scale: 1, x_offset: -1000, y_offset: -1000, x_anchor: min, y_anchor: min, width: 1, height: 1}}
"""


class Folder(http.server.SimpleHTTPRequestHandler):
    def log_message(self, *_):
        pass


@pytest.fixture
def server(tmp_path):
    root = tmp_path / "www"
    root.mkdir()
    found = http.server.ThreadingHTTPServer(("127.0.0.1", 0), lambda *a: Folder(*a, directory=str(root)))
    threading.Thread(target=found.serve_forever, daemon=True).start()
    yield root, f"http://127.0.0.1:{found.server_port}"
    found.shutdown()


def catalogue(path, rows):
    """A GeoPackage of work units: (workunit, lpc_link, collect_end, box)."""
    ring = lambda x0, y0, x1, y1: [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]
    with sqlite3.connect(path) as db:
        db.executescript("CREATE TABLE gpkg_spatial_ref_sys (srs_id INTEGER, organization TEXT, organization_coordsys_id INTEGER); CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, srs_id INTEGER); CREATE TABLE units (fid INTEGER PRIMARY KEY, geom BLOB, workunit TEXT, project TEXT, lpc_link TEXT, sourcedem_link TEXT, collect_end TEXT, horiz_crs TEXT)")
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (1, 'EPSG', 4269)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('units', 'geom', 1)")
        for k, (unit, link, end, box) in enumerate(rows):
            points = ring(*box)
            shape = struct.pack("<BIII", 1, 3, 1, len(points)) + b"".join(struct.pack("<2d", *p) for p in points)
            db.execute("INSERT INTO units VALUES (?, ?, ?, 'p', ?, '', ?, '4326')", (k + 1, b"GP\0\1" + struct.pack("<i", 1) + shape, unit, link, end))
    db.close()


def boxes_of(spark, **named):
    return spark.createDataFrame([(n, *map(float, b), "EPSG:4326", k) for k, (n, b) in enumerate(named.items())], regions.SCHEMA)


def test_work_units_from_catalogue_to_surfaces(spark, tmp_path, server):
    root, url = server
    for unit, names in (("old", ["t_E1010N1020.las", "t_E1011N1020.las", "PROJ_.las"]), ("new", ["t_E1010N1020_LAS_2020.las"])):
        (root / unit).mkdir()
        (root / unit / units.LIST).write_text("\n".join(f"{url}/{unit}/{n}" for n in [*names, names[0]]))
        for n in names:
            las.write_las(str(root / unit / n), np.array([0.0, 1.0, 1.0]), np.array([0.0, 0.0, 2.0]), np.array([5.0, 7.0, 9.0]), np.array([2, 2, 1]))
    cache = tmp_path / "cache"
    cache.mkdir()
    catalogue(str(cache / "WESM.gpkg"), [("u_old", f"{url}/old", "2015-01-01", (9, 19, 13, 22)), ("u_new", f"{url}/new", "2020-01-01", (9, 19, 13, 22)), ("u_far", f"{url}/far", "2021-01-01", (50, 50, 51, 51)), ("x_none", None, "2022-01-01", (9, 19, 13, 22))])
    rules = tmp_path / "rules.yaml"
    rules.write_text(RULES)
    own = dict(rules=str(rules), cache_dir=str(cache), link_cache_dir=str(tmp_path / "links"), least_bytes=1)
    boxes = boxes_of(spark, a=(10.2, 20.2, 10.8, 20.8), b=(10.5, 20.5, 11.5, 20.9))
    source = ready.UnitClouds(**own)
    wanted = {(r["region_id"], r["filename"]) for r in source.plan(boxes).collect()}
    assert wanted == {("a", "t_E1010N1020_LAS_2020.las"), ("b", "t_E1010N1020_LAS_2020.las"), ("b", "t_E1011N1020.las")}  # the new tile covers the old one
    audit = {r["workunit"]: r for r in source.audit(boxes).collect()}
    assert {k: (v["status"], v["files"], v["parsed"], v["duplicates"], v["placeholders"]) for k, v in audit.items()} == {"u_old": ("matched", 2, 2, 1, 1), "u_new": ("matched", 1, 1, 1, 0), "x_none": ("unmatched", 0, 0, 0, 0)}
    assert audit["x_none"]["error"] == "the unit has no list"
    assert sorted(os.listdir(tmp_path / "links")) == sorted(units.cache_name(f"{url}/{u}/{units.LIST}") for u in ("old", "new"))
    replayed = ready.UnitClouds(**own, get=units.offline)
    files, ordered = replayed.planned(boxes)
    rows, states = units.replay_report(files, ordered, boxes, units.select_clouds(files, boxes, ordered, 1.0))
    assert {r["workunit"]: r["selected"] for r in rows.collect()} == {"u_old": 1, "u_new": 1, "x_none": 0}
    assert {(r["state"], r["targets"], r["covered"]) for r in states.collect()} == {("a", 1, 1), ("b", 1, 1)}
    raster = ready.UnitClouds(**own, output_products=["dsm"])
    pipeline = components.Pipeline("p", raster, output_dir=str(tmp_path / "out"), retry_delay=0.0)
    assets, found = pipeline.run(spark, boxes)
    assert {r["state"] for r in found.collect()} == {"complete"}
    assert sorted(os.listdir(tmp_path / "out")) == ["t_E1010N1020_LAS_2020_dsm.tif", "t_E1011N1020_dsm.tif"]
    head = geotiff.read_header(str(tmp_path / "out" / "t_E1011N1020_dsm.tif"))
    assert (head.width, head.height, head.bounds, head.crs) == (1, 2, (0.0, 0.0, 1.0, 2.0), "EPSG:4326")
    with pytest.raises(ValueError):
        ready.UnitClouds(**own, output_products=["other"])


def test_catalogue_is_fetched_whole(tmp_path, server):
    root, url = server
    (root / "c.gpkg").write_bytes(b"x" * 1000)
    path = str(tmp_path / "c.gpkg")
    with open(path, "wb") as f:
        f.write(b"x" * 10)
    with pytest.raises(ValueError, match="whole"):
        units.ensure_catalogue(f"{url}/c.gpkg", path, 5000, retries=0)
    assert not os.path.exists(path)
    assert units.ensure_catalogue(f"{url}/c.gpkg", path, 1000, retries=0) == path and os.path.getsize(path) == 1000


def test_cached_lists(tmp_path):
    asked = []
    get = lambda u: asked.append(u) or f"text {len(asked)}"
    url = "https://host/some folder/list.txt"
    read = lambda now: units.cached_text(url, str(tmp_path), 1.0, get, lambda: now)
    first = read(0)
    stamp = os.path.getmtime(tmp_path / units.cache_name(url))
    assert first == "text 1" and read(stamp + 100) == "text 1" and read(stamp + 2 * units.DAY) == "text 2" and units.cached_text(url, str(tmp_path), 0.0, units.offline) == "text 2"
    with pytest.raises(OSError):
        units.cached_text(url + "x", str(tmp_path), 1.0, units.offline)


def test_headers_of_packed_clouds(spark, tmp_path):
    path = str(tmp_path / "a.las")
    las.write_las(path, np.array([1.0, 4.0]), np.array([2.0, 5.0]), np.array([0.0, 1.0]), np.array([1, 2]))
    raw = bytearray(open(path, "rb").read())
    keys = struct.pack("<12H", 1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, 26918)
    text = b'PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4269"]],AUTHORITY["EPSG","6347"]],VERT_CS["v",AUTHORITY["EPSG","5703"]]\0'
    record = lambda n, body: struct.pack("<H16sHH32s", 0, b"LASF_Projection", n, len(body), b"") + body
    for records, code in ((record(34735, keys), 26918), (record(34735, keys) + record(2112, text), 6347), (b"", None)):
        packed = bytearray(raw[:227] + records + raw[227:])
        packed[104] |= 128
        struct.pack_into("<II", packed, 96, 227 + len(records), (len(records) > 0) + (code == 6347))
        head = las.parse_header(bytes(packed), "b.laz")
        assert (head.epsg, head.packed, head.bounds, head.count) == (code, True, (1.0, 2.0, 4.0, 5.0), 2)
    heads = {"u1": bytes(packed[:400]), "u2": b"<html>"}
    got = {r["url"]: r for r in units.sample_headers(spark.createDataFrame([("u1",), ("u2",)], "url string"), heads.__getitem__).collect()}
    assert (got["u1"]["minx"], got["u1"]["points"]) == (1.0, 2) and "no LAS" in got["u2"]["error"]
    assert las.system_of(head, "EPSG:1") == "EPSG:1"
    with pytest.raises(ValueError):
        las.system_of(head)


def test_paged_portal(spark, tmp_path):
    square = lambda x: {"type": "Polygon", "coordinates": [[[x, 40.0], [x + 0.1, 40.0], [x + 0.1, 40.1], [x, 40.1], [x, 40.0]]]}
    names = {"1": "MDT50CM-ETRS89-H30-0001.tif", "2": "MDT50CM-ETRS89-H31-0001.tif", "3": "MDT50CM-ETRS89-H30-0002.tif"}
    place = {"1": 0.0, "2": 0.0, "3": 5.0}

    def post(url, form):
        if url == "footprints":
            return json.dumps({"coordsJson": json.dumps({"features": [{"geometry": square(place[form["secuencial"]])}]})})
        page = int(form["numPagina"])
        own = sorted(names)[page * 2 - 2 : page * 2]
        rows = "".join(f'<tr><td id="linkDescDirS3_{s}">x {names[s]} y</td></tr>' for s in own)
        return f'<input id="totalArchivos" type="hidden" value="3"><table>{rows}</table>'

    source = ready.PortalFiles(footprint_cache_path=str(tmp_path / "f.json"), post=post, urls=("files", "footprints", "get"))
    got = source.plan(boxes_of(spark, a=(0.02, 40.02, 0.05, 40.05))).collect()
    assert [(r["region_id"], r["filename"], r["form"]) for r in got] == [("a", names["2"], {"secDescDirLA": "2"})]  # zone 31 begins at the meridian
    assert set(portals.read_cache(str(tmp_path / "f.json"))) == {"1", "2", "3"}
    with pytest.raises(Exception, match="more than"):
        ready.PortalFiles(footprint_cache_path=str(tmp_path / "f.json"), post=post, urls=("files", "footprints", "get"), most=0).plan(boxes_of(spark, a=(0.02, 40.02, 0.05, 40.05))).collect()
    assert portals.read_cache(str(tmp_path / "none.json")) == {}
    for bad in ('{"features": []}', json.dumps({"features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}}]})):
        with pytest.raises(ValueError):
            portals.one_footprint(json.dumps({"coordsJson": bad}))
    for portal, name in (("cnig", "other"), ("pe3d", "orthoimage")):
        with pytest.raises(ValueError):
            portals.product(portal, name)


def test_sheet_portal(spark, tmp_path):
    boxes = boxes_of(spark, a=(-35.02, -8.02, -35.0, -8.0))
    source = ready.SheetArchives(str(tmp_path / "q.json"), None)
    sheet = sorted(r["sheet"] for r in source.sheets(boxes).collect())[0]
    corners = source.sheets(boxes).collect()
    assert corners
    x, y = -35.015625, -8.0104
    ring = [[x - 0.015, y - 0.01], [x + 0.015, y - 0.01], [x + 0.015, y + 0.01], [x - 0.015, y + 0.01]]
    (tmp_path / "q.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"properties": {"id_quad": "77", "name": "m", "color": "green"}, "geometry": {"coordinates": [ring]}}]}))
    asked = []

    def pages(ids):
        asked.append(ids)
        return [f'<iframe src="/d/1_5000/4_MDT_RASTER/MDT-{s}.zip"></iframe>' for s in found]

    from geoloom.sources import catalogs

    known = catalogs.quadrangles(spark.read.text(str(tmp_path / "q.json"), wholetext=True).withColumnRenamed("value", "document")).collect()
    found = [known[0]["sheet"]]
    source = ready.SheetArchives(str(tmp_path / "q.json"), pages)
    _, links, states = source.resolved(boxes)
    states = {r["sheet"]: (r["status"], r["error"]) for r in states.collect()}
    assert asked[0] == ["77"] and [r["filename"] for r in links.collect()] == [f"MDT-{found[0]}.zip"]
    assert states[found[0]] == ("planned", None) and all(v == ("failed", "the catalogue has no such sheet") for k, v in states.items() if k != found[0])
    with zipfile.ZipFile(tmp_path / f"MDT-{sheet}.zip", "w") as z:
        z.writestr(f"d/mdt-{sheet}.TIF", b"raster")
        z.writestr(f"d/mdt-{sheet}.tfw", b"world")
    out = source.materialize()(str(tmp_path / f"MDT-{sheet}.zip"))
    assert out == source.product()(str(tmp_path / f"MDT-{sheet}.zip")) and open(out, "rb").read() == b"raster" and not os.path.exists(tmp_path / f"MDT-{sheet}.zip")


def test_sessions_and_sign_in(tmp_path):
    import urllib.error

    now, signed = [0.0], []

    def sign_in(refresh):
        signed.append(refresh)
        if refresh == "bad":
            raise ValueError("no")
        return f"t{len(signed)}", "bad" if len(signed) == 4 else "r"

    session = portals.Session(sign_in, lambda: now[0])
    assert session.token() == session.token() == "t1"
    now[0] = 500
    assert session.token() == "t2" and signed == [None, "r"]
    now[0] = 3400
    assert session.token() == "t3" and signed[-1] is None
    now[0] = 3900
    assert session.token() == "t4"
    now[0] = 4400
    assert session.token() == "t6" and signed[-2:] == ["bad", None]  # a refresh that fails signs in

    def ask(token):
        if token == "t6":
            raise urllib.error.HTTPError("u", 401, "no", {}, None)
        return token

    assert session.call(ask) == "t7"
    said = iter(["", "wrong", "right"])
    path = str(tmp_path / "c" / "picture.png")
    assert portals.sign_in_by_picture(lambda: b"png", lambda a: "ok" if a == "right" else "no", path, lambda p: next(said)) == 3 and not os.path.exists(path)
    with pytest.raises(portals.Refused):
        portals.sign_in_by_picture(lambda: b"png", lambda a: "no", path, lambda p: "x", 2)
    assert portals.cookie_header({"a": "1", "b": "2"}) == {"Cookie": "a=1; b=2"} and portals.verification() is True
    with pytest.raises(ValueError):
        portals.verification(False, path)


def test_json_with_retries(server):
    root, url = server
    (root / "a.json").write_text('{"x": 1}')
    (root / "b.html").write_text("<p>")
    waits = []
    assert portals.get_json(f"{url}/a.json") == {"x": 1}
    with pytest.raises(portals.Refused):
        portals.get_json(f"{url}/b.html")
    with pytest.raises(OSError):
        portals.get_json("http://127.0.0.1:1/none", sleep=waits.append)
    assert waits == [1.0, 2.0]


def test_region_files(spark, tmp_path):
    path = tmp_path / "p.geojson"
    feature = lambda kind, places, **p: {"properties": p, "geometry": {"type": kind, "coordinates": places}}
    write = lambda *f: path.write_text(json.dumps({"features": f}))
    write(feature("Point", [-75.0, 40.0], id="a", use=" yes "), feature("Point", [-75.0, 41.0], id="b", use="no"))
    row = regions.geojson_points(spark, str(path), "id", 1000.0, {"use": ["yes"]}).collect()
    assert [r["region_id"] for r in row] == ["a"]
    east = alignment.geodesic_length(np.array([row[0]["minx"]]), np.array([40.0]), np.array([row[0]["maxx"]]), np.array([40.0]))
    assert east == pytest.approx(1000.0, abs=0.01)
    assert regions.geojson_points(spark, str(path), None, 10.0, None, "EPSG:32618").where("maxx - minx = 10").count() == 2
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    write(feature("MultiPolygon", [[square], [[[5, 5], [6, 5], [6, 6], [5, 5]]]], id="m"))
    one = regions.geojson_polygons(spark, str(path), "id").first()
    assert (one["maxx"], len(one["polygons"])) == (6.0, 2)
    moved = regions.reprojected(regions.geojson_polygons(spark, str(path), "id"), "EPSG:3857").first()
    assert moved["polygons"][0][0][1][0] == pytest.approx(2 * 111319.49, abs=0.1)
    for bad, message in ((feature("Polygon", [[[0, 0], [2, 2], [2, 0], [0, 2], [0, 0]]], id="x"), "cross|without area"), (feature("Polygon", [[[0, 0], [500, 0], [500, 2], [0, 0]]], id="x"), "degrees"), (feature("LineString", [[0, 0], [1, 1]], id="x"), "no polygon"), (feature("Polygon", [square], id="a/b"), "usable")):
        write(bad)
        with pytest.raises(Exception, match=message):
            regions.geojson_polygons(spark, str(path), "id").collect()
    write(feature("Polygon", [square], id="a"), feature("Polygon", [square], id="a"))
    with pytest.raises(Exception, match="called a"):
        regions.geojson_polygons(spark, str(path), "id").collect()


def test_systems():
    assert crs.horizontal("EPSG:4326+3855") == "EPSG:4326" and crs.vertical("EPSG:4326+3855") == "EPSG:3855".join(("EGM2008 height (", ")"))
    assert crs.vertical("EPSG:4326") is None and crs.vertical("EPSG:5703") == "NAVD88 height (EPSG:5703)"
    for bad in ("EPSG:5703", "EPSG:1"):
        with pytest.raises(ValueError):
            crs.horizontal(bad)
    assert alignment.geodesic_length(np.array([0.0, 10.0]), np.array([0.0, 50.0]), np.array([1.0, 10.0]), np.array([0.0, 51.0])) == pytest.approx([111319.491, 111240.0], abs=40)


def test_alignment_step_writes_masked_rasters(spark, tmp_path):
    source, target, out = tmp_path / "s", tmp_path / "t", tmp_path / "o"
    for folder in (source, target, out):
        folder.mkdir()
    values = np.arange(20 * 30, dtype=np.float32).reshape(20, 30)
    mask = np.ones((20, 30), bool)
    mask[3, 4] = False
    geotiff.write_geotiff(str(source / "one.tif"), values, 500000.0, 4500000.0, 10.0, None, 32618, tags={"A&B": "<1>"}, mask=mask)
    assert geotiff.read_metadata(str(source / "one.tif")) == {"A&B": "<1>"}
    geotiff.write_geotiff(str(target / "r.tif"), np.zeros((10, 10), np.float32), 500020.0, 4499980.0, 10.0, -1.0, 32618)
    boxes = ready.RasterRegions(str(target)).regions(spark)
    assets = spark.createDataFrame([("r", "one.tif", str(source / "one.tif"), "success", None)], "region_id string, filename string, path string, status string, error string")
    step = ready.AlignToTarget("dem", output_dir=str(out), resampling="nearest")
    done = step.process(assets, boxes).collect()
    assert [(r["region_id"], r["status"], r["path"]) for r in done] == [("r", "success", step.expected("r"))]
    cells = {(r["row"], r["col"]): r["value"] for r in rasters.read_cells(spark.createDataFrame([("x", step.expected("r"))], "raster_id string, path string")).collect()}
    assert cells == {(r, c): float(values[r + 2, c + 2]) for r in range(10) for c in range(10) if (r + 2, c + 2) != (3, 4)}
    assert geotiff.read_metadata(step.expected("r"))["RESAMPLING"] == "nearest"
    native = ready.AlignToTarget("raw", output_dir=str(out), resample=False)
    assert native.process(assets, boxes).first()["status"] == "success"
    assert geotiff.read_header(native.expected("r")).bounds == (500020.0, 4499880.0, 500120.0, 4499980.0)
    pipeline = components.Pipeline("p", ready.DegreeTiles(), [step])
    assert pipeline.pending(spark, boxes, ".").count() == 0
    with pytest.raises(Exception, match="no grid of 3"):
        ready.AlignToTarget("x", output_dir=str(out), target_scale=3).process(assets, boxes).collect()


def test_native_window_step(spark, tmp_path):
    for folder in ("s", "o"):
        (tmp_path / folder).mkdir()
    values = np.arange(40 * 40, dtype=np.float32).reshape(40, 40)
    geotiff.write_geotiff(str(tmp_path / "s" / "a.tif"), values[:, :20], 500000.0, 4500000.0, 10.0, None, 32618)
    geotiff.write_geotiff(str(tmp_path / "s" / "b.tif"), np.vstack([values[:, 20:]]), 500200.0, 4500000.0, 10.001, None, 32618)
    names = [str(tmp_path / "s" / n) for n in ("a.tif", "b.tif")]
    assets = spark.createDataFrame([(r, os.path.basename(n), n, "success", None) for r in ("p", "q") for n in names], "region_id string, filename string, path string, status string, error string")
    points = spark.createDataFrame([("p", 500185.0, 4499800.0, "EPSG:32618"), ("q", 700000.0, 4499800.0, "EPSG:32618")], "region_id string, x double, y double, crs string")
    strict = {r["region_id"]: r for r in ready.NativeWindow("w", 80.0, output_dir=str(tmp_path / "o")).process(assets, points).collect()}
    assert strict["p"]["status"] == "failed" and "valid" in strict["p"]["error"] and strict["q"]["error"] == "no source contains the point"
    step = ready.NativeWindow("w", 80.0, output_dir=str(tmp_path / "o"), fallback_resampling="bilinear", max_resampled_fraction=0.5)
    assert {r["region_id"]: r["status"] for r in step.process(assets, points).collect()} == {"p": "success", "q": "failed"}
    head = geotiff.read_header(step.expected("p"))
    assert (head.width, head.height) == (8, 8)
    told = geotiff.read_metadata(step.expected("p"))
    assert told["RESAMPLING"] == "partial_bilinear" and int(told["RESAMPLED_PIXELS"]) == 16 and told["VALID_FRACTION"] == "1.0"
    cells = {(r["row"], r["col"]): r["value"] for r in rasters.read_cells(spark.createDataFrame([("x", step.expected("p"))], "raster_id string, path string")).collect()}
    left = round((head.bounds[0] - 500000.0) / 10)
    top = round((4500000.0 - head.bounds[3]) / 10)
    assert all(cells[r, c] == values[top + r, left + c] for r in range(8) for c in range(20 - left))
    assert cells[3, 7] == pytest.approx(values[top + 3, left + 7], abs=1.0)


def test_record_of_a_run(spark, tmp_path):
    rows = [
        ("p", 1, 0.0, "pipeline", None, None, None, None, 2.0), ("p", 2, 0.0, "region", "a", "oa", "pending", "ta", None), ("p", 3, 0.0, "region", "b", "ob", "pending", "tb", None), ("p", 4, 0.0, "region", "c", "oc", "existing", "tc", None),
        ("p", 5, 1.0, "request", "a", "f1", None, "u1", None), ("p", 6, 1.0, "request", "b", "f1", None, "u1", None), ("p", 7, 1.0, "request", "b", "f2", None, "u2", None), ("p", 8, 2.0, "started", None, "f1", None, None, None), ("p", 9, 3.0, "started", None, "f2", None, None, None),
        ("p", 10, 5.0, "transfer", None, "f1", "success", None, 9.0), ("p", 11, 6.0, "finished", None, "f1", None, None, None), ("p", 12, 8.0, "finished", None, "f2", None, "broken", None), ("p", 13, 9.0, "ready", "a", None, None, None, None), ("p", 14, 9.5, "building", "a", None, None, None, None), ("p", 15, 9.9, "built", "a", "oa", None, None, None),
    ]
    log = spark.createDataFrame(rows, runstate.EVENTS)
    states = lambda frame: {r["region_id"]: (r["state"], r["error"]) for r in runstate.region_states(frame).collect()}
    assert states(log) == {"a": ("complete", None), "b": ("pending", None), "c": ("existing", None)}
    closed = log.union(spark.createDataFrame([("p", 16, 10.0, "closed", None, None, None, None, None)], runstate.EVENTS))
    assert states(closed)["b"] == ("failed", "1 required files failed")
    assert runstate.average_active(log).first()["average_active"] == 1.5
    assert {r["level"] for r in runstate.lines(log).collect()} == {"INFO", "ERROR"}
    path = str(tmp_path / "r" / "run.json")
    assert runstate.load(path) is None
    runstate.save(runstate.document(closed, "test"), path)
    old = runstate.load(path)
    assert old["errors"] and old["status"] == "running" and [f["status"] for f in old["files"]] == ["complete", "failed"]
    previous, inputs, errors = runstate.as_frames(spark, old)
    again = spark.createDataFrame([("p", 1, 0.0, "region", r, "o" + r, s, "t" + r, None) for r, s in (("a", "existing"), ("b", "pending"), ("c", "existing"))], runstate.EVENTS)
    got = {r["region_id"]: (r["state"], r["previous_state"], r["required"]) for r in runstate.resumed(again, previous, inputs).collect()}
    assert got == {"a": ("existing", "complete", ["f1"]), "b": ("pending", "failed", []), "c": ("existing", "existing", [])}
    with pytest.raises(Exception, match="other inputs"):
        runstate.resumed(again.withColumn("text", F.lit("else")), previous, inputs).collect()
    assert runstate.errors(again, errors).where("earlier").count() == len(old["errors"])
    assert runstate.document(again, "x", old)["resume_count"] == 1
    reached: dict = {}
    assert runstate.due(log, reached, {"p": 10}, {"p": 4}) == ["finished", "pipeline", "40_percent"] and runstate.due(log.where("false"), reached, {"p": 10}, {"p": 4}) == []
    with open(path, "w") as f:
        f.write('{"schema_version": 9}')
    with pytest.raises(ValueError):
        runstate.load(path)
    report = spark.createDataFrame([("a", "x", "p", "success", None)], "region_id string, asset_id string, path string, status string, error string")
    more = runstate.add_failures(runstate.add_assets(report, report, "reused"), spark.createDataFrame([("b", "y", "bad")], "region_id string, asset_id string, error string"))
    assert sorted(r["status"] for r in more.collect()) == ["failed", "reused", "success"]
    with pytest.raises(ValueError):
        runstate.add_assets(report, report, "failed")


def test_checkpoints_of_a_stream(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "state.json")
    source.mkdir()
    log = lambda: spark.read.schema(runstate.EVENTS).parquet(str(source))
    query = spark.readStream.schema(runstate.EVENTS).parquet(str(source)).writeStream.foreachBatch(runstate.checkpointing(log, path)).option("checkpointLocation", str(tmp_path / "c")).start()
    reasons = []
    for rows in ([("p", 1, 0.0, "region", "a", "oa", "pending", "t", None)], [("p", 2, 0.0, "pipeline", None, None, None, None, 1.0)], [("p", 3, 1.0, "built", "a", "oa", None, None, None)]):
        spark.createDataFrame(rows, runstate.EVENTS).coalesce(1).write.mode("append").parquet(str(source))
        query.processAllAvailable()
        reasons.append(json.load(open(path))["last_checkpoint"]["reason"] if os.path.exists(path) else None)
    query.stop()
    assert reasons == [None, "pipeline", "100_percent"]


def test_files_are_handed_over_once(spark, tmp_path):
    from geoloom.streaming import ledger as stream

    source, out = tmp_path / "in", []
    source.mkdir()
    events = spark.readStream.schema(stream.EVENTS).parquet(str(source))
    query = stream.deliver(events).writeStream.foreachBatch(lambda frame, _: out.extend(map(tuple, frame.collect()))).option("checkpointLocation", str(tmp_path / "c")).start()
    for rows in ([("a", 1, "need", "f"), ("b", 2, "need", "f")], [(None, 3, "done", "f")], [("c", 4, "need", "f"), ("a", 5, "need", "f")]):
        spark.createDataFrame(rows, stream.EVENTS).coalesce(1).write.mode("append").parquet(str(source))
        query.processAllAvailable()
    assert sorted(out) == [("f", "a", "success"), ("f", "b", "reused"), ("f", "c", "reused")]
    spark.createDataFrame([(None, 6, "done", "f")], stream.EVENTS).coalesce(1).write.mode("append").parquet(str(source))
    with pytest.raises(Exception, match="twice"):
        query.processAllAvailable()


def test_downloads_post_forms_and_convert(spark, tmp_path, server):
    root, url = server
    (root / "a.txt").write_text("abc")

    def convert(path, detail):
        if path.endswith("bad.txt"):
            raise ValueError("cannot convert")
        os.replace(path, path + ".up")
        return path + ".up"

    requests = spark.createDataFrame([(f"{url}/a.txt", "a.txt"), (f"{url}/a.txt", "bad.txt")], "url string, filename string")
    got = {r["filename"]: (r["status"], r["error"]) for r in download.download(requests, str(tmp_path / "o"), 0, 0.0, materialize=convert, product=lambda p: p + ".up").collect()}
    assert got == {"a.txt": ("success", None), "bad.txt": ("failed", "cannot convert")}
    again = {r["filename"]: r["status"] for r in download.download(requests, str(tmp_path / "o"), 0, 0.0, materialize=convert, product=lambda p: p + ".up").collect()}
    assert again["a.txt"] == "skipped" and not any(n.endswith(".lock") for n in os.listdir(tmp_path / "o"))


def test_dated_and_degree_tiles(spark):
    boxes = boxes_of(spark, a=(10.1, 20.1, 10.2, 20.2))
    listed = json.dumps({"7": {"itemTitle": "World (Wayback 2020-01-01)"}, "9": {"itemTitle": "World (Wayback 2021-01-01)"}})
    urls = [r["url"] for r in ready.DatedTiles("2020-03-01", 3, "https://h/{version}/{z}/{y}/{x}", get=lambda u: listed).plan(boxes).collect()]
    assert urls == ["https://h/7/3/3/4"]
    row = ready.DegreeTiles(filename_suffix="x", base="https://h").plan(boxes).first()
    assert (row["url"], row["filename"]) == ("https://h/Copernicus_DSM_COG_10_N20_00_E010_00_DEM/Copernicus_DSM_COG_10_N20_00_E010_00_DEM.tif", "Copernicus_DSM_10_N20_00_E010_00_DEM_x.tif")
    found = json.dumps({"value": [{"Id": "b", "Attributes": [{"Name": "dataset", "Value": "x/2021_1"}]}, {"Id": "a", "Attributes": [{"Name": "dataset", "Value": "x/2022_1"}]}]})
    asked = []
    plan = ready.SearchedTiles(lambda f: asked.append(f) or found, "https://h/{product_id}").plan(boxes).first()
    assert plan["url"] == "https://h/a" and "N20E010" in asked[0] and "SAR_DGE_30_A4AD" in asked[0]


def test_two_streams_fetch_and_process(spark, tmp_path, server):
    from geoloom.streaming import acquire

    root, url = server
    for n in "abc":
        (root / f"{n}.txt").write_text(n)
    folder, out, seen = str(tmp_path / "work"), tmp_path / "files", []
    rows = [("a.txt", f"{url}/a.txt", ["r1", "r2"], 1), ("b.txt", f"{url}/b.txt", ["r1"], 2), ("c.txt", f"{url}/c.txt", ["r3"], 3), ("d.txt", f"{url}/none.txt", ["r2"], 4)]
    acquire.write_requests(spark.createDataFrame(rows, acquire.REQUESTS), folder, 1)
    assert len([n for n in os.listdir(f"{folder}/requests") if n.startswith("part-")]) == 1
    os.makedirs(f"{folder}/ended")
    fetching = acquire.fetch_stream(spark, folder, str(out), 1, 0, 0.0)
    fetching.processAllAvailable()
    ready_ones = acquire.ready_stream(spark, folder, lambda batch: seen.extend(map(tuple, batch.collect())))
    ready_ones.processAllAvailable()
    fetching.stop()
    ready_ones.stop()
    assert sorted(seen) == [("r1", "ready", 2), ("r2", "failed", 1), ("r3", "ready", 1)] and sorted(os.listdir(out))[:3] == ["a.txt", "b.txt", "c.txt"]
