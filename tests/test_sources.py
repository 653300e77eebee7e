"""Files and catalogues that sources read, downloads and settings."""

import functools
import http.server
import json
import os
import sqlite3
import struct
import threading
import zipfile
import zlib

import numpy as np
import pytest

from geoloom import __main__ as cli
from geoloom import components, settings
from geoloom.functions import wkb
from geoloom.sources import archives, catalogs, download, geopackage, geotiff, listing, rasters, shapefile

SQUARE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]


def polygon(*rings):
    return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<2d", *p) for p in r) for r in rings)


def box(x0, y0, x1, y1):
    return [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]


def documents(spark, *values):
    return spark.createDataFrame([(f"https://host/a/{k}.json", json.dumps(v)) for k, v in enumerate(values)], "url string, document string")


def test_wkb():
    assert wkb.parse(polygon(SQUARE, HOLE)) == ("Polygon", [[SQUARE, HOLE]])
    high = struct.pack(">BI3d", 0, 1001, 1.0, 2.0, 9.0)
    assert wkb.parse(high) == ("Point", [[[(1.0, 2.0)]]])
    many = struct.pack("<BII", 1, 6, 2) + polygon(SQUARE) + polygon(HOLE)
    assert wkb.parse(many) == ("MultiPolygon", [[SQUARE], [HOLE]])
    assert wkb.bounds_of(many) == (0.0, 0.0, 4.0, 4.0) and wkb.bounds_of(struct.pack("<BII", 1, 3, 0)) is None
    with pytest.raises(ValueError):
        wkb.parse(struct.pack("<BII", 1, 2, 0))


@pytest.mark.parametrize("indexed", [True, False])
def test_geopackage(spark, tmp_path, indexed):
    path = str(tmp_path / "c.gpkg")
    with sqlite3.connect(path) as db:
        db.executescript("CREATE TABLE gpkg_spatial_ref_sys (srs_id INTEGER, organization TEXT, organization_coordsys_id INTEGER); CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, srs_id INTEGER); CREATE TABLE units (fid INTEGER PRIMARY KEY, geom BLOB, workunit TEXT, n INTEGER)")
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (1, 'EPSG', 4269)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('units', 'geom', 1)")
        for k in range(30):
            head = b"GP\0\3" + struct.pack("<i4d", 1, k, k + 1, 0, 1) if k % 2 else b"GP\0\1" + struct.pack("<i", 1)
            db.execute("INSERT INTO units VALUES (?, ?, ?, ?)", (k + 1, None if k == 29 else head + polygon(box(k, 0, k + 1, 1)), f"w{k}", None if k == 3 else k))
        if indexed:
            db.execute("CREATE VIRTUAL TABLE rtree_units_geom USING rtree(id, minx, maxx, miny, maxy)")
            db.executemany("INSERT INTO rtree_units_geom VALUES (?, ?, ?, 0, 1)", [(k + 1, k, k + 1) for k in range(29)])
    db.close()
    spark.dataSource.register(geopackage.GeoPackageSource)
    read = spark.read.format("geopackage").option("path", path).option("rowsPerPartition", 7)
    everything = read.load().collect()
    assert len(everything) == 30 and everything[3]["n"] is None and {r["crs"] for r in everything} == {"EPSG:4269"}
    assert sorted(r["fid"] for r in everything if r["minx"] is None) == [30]
    near = read.option("bbox", "5,0,6.5,1").option("columns", "workunit").load()
    assert near.columns == ["fid", "workunit", "minx", "miny", "maxx", "maxy", "wkb", "crs"]
    assert sorted((r["workunit"], r["minx"]) for r in near.collect()) == [("w4", 4.0), ("w5", 5.0), ("w6", 6.0)]
    assert near.select(wkb.shapes("wkb").alias("s")).where("s.geometry_type = 'Polygon' and size(s.polygons[0][0]) = 5").count() == 3
    with pytest.raises(Exception, match="no columns"):
        read.option("columns", "workunit,absent").load()


def write_shapefile(stem, shapes, rows):
    bodies = []
    for rings in shapes:
        if rings is None:
            bodies.append(struct.pack("<i", 0))
            continue
        points = [p for r in rings for p in r]
        xs, ys = zip(*points, strict=True)
        starts = [sum(len(r) for r in rings[:k]) for k in range(len(rings))]
        bodies.append(struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points))
    at, shp, shx = 50, b"", b""
    for k, body in enumerate(bodies):
        shp += struct.pack(">2i", k + 1, len(body) // 2) + body
        shx += struct.pack(">2i", at, len(body) // 2)
        at += 4 + len(body) // 2
    for extension, raw in ((".shp", shp), (".shx", shx)):
        with open(stem + extension, "wb") as f:
            f.write(struct.pack(">i", 9994).ljust(100, b"\0") + raw)
    field = b"ID".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([8, 0]) + b"\0" * 14
    with open(stem + ".dbf", "wb") as f:
        f.write(struct.pack("<4BIHH20x", 3, 124, 1, 1, len(rows), 65, 9) + field + b"\r" + b"".join(r for r in rows) + b"\x1a")
    with open(stem + ".prj", "w") as f:
        f.write("GEOGCS[]")


def test_shapefile(spark, tmp_path):
    other = box(10.0, 10.0, 11.0, 11.0)
    stem = str(tmp_path / "r")
    write_shapefile(stem, [[SQUARE, HOLE], [SQUARE, other], None, [other]], [b" a       ", b" b       ", b" c       ", b"*d       "])
    spark.dataSource.register(shapefile.ShapefileSource)
    got = spark.read.format("shapefile").option("recordsPerPartition", 1).load(stem + ".shp").collect()
    assert [(r["feature_index"], r["geometry_type"], r["properties"], r["maxx"], r["crs"]) for r in sorted(got)] == [(0, "Polygon", {"ID": "a"}, 4.0, "GEOGCS[]"), (1, "MultiPolygon", {"ID": "b"}, 11.0, "GEOGCS[]")]
    assert [[len(p) for p in r["polygons"]] for r in sorted(got)] == [[2], [1, 1]]


def test_listing(spark, tmp_path):
    for name in ("0.tif", "0_lidar.tif", "1.TIF", "2.tiff", "2_lidar.tif", "note.txt"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "3.tif").write_bytes(b"x")
    files = listing.folder(spark, str(tmp_path))
    assert sorted(r["name"] for r in listing.target_rasters(files, ["_lidar"]).collect()) == ["0.tif", "1.TIF", "2.tiff"]
    assert [r["stem"] for r in listing.without_outputs(files, ["lidar"]).collect()] == ["1"]
    assert [r["stem"] for r in listing.pairs(files).collect()] == ["0"]


def test_stac(spark):
    links = [{"rel": "item", "href": "./x.json"}, {"rel": "self", "href": "y"}, {"rel": "item", "href": "./x.json"}, {"rel": "item", "href": "https://else/z.json"}]
    found = catalogs.stac_item_links(documents(spark, {"links": links})).collect()
    assert sorted(r["item_url"] for r in found) == ["https://else/z.json", "https://host/a/x.json"]
    item = {"id": " BQ31 ", "bbox": [1, 2, 3, 4], "geometry": {"type": "Polygon", "coordinates": [[[1, 2]]]}, "properties": {"datetime": "2020", "end_datetime": "2021"}}
    plain = item | {"assets": {"thumb": {"href": "t.jpg"}, "one": {"href": "d/one.TIF?x=1", "file:checksum": "c1"}, "two": {"href": "two.tiff"}}}
    visual = item | {"assets": {"one": {"href": "one.tif"}, "visual": {"href": "v", "type": "image/tiff; application=geotiff"}}}
    got = catalogs.stac_items(documents(spark, plain, visual), "url").orderBy("item_url").collect()
    assert [(r["tile_id"], r["maxx"], r["url"], r["checksum"], r["start_datetime"], r["end_datetime"]) for r in got] == [("BQ31", 3.0, "https://host/a/d/one.TIF?x=1", "c1", "2020", "2021"), ("BQ31", 3.0, "https://host/a/v", None, "2020", "2021")]
    with pytest.raises(Exception, match="no GeoTIFF"):
        catalogs.stac_items(documents(spark, item | {"assets": {"thumb": {"href": "t.jpg"}}}), "url").collect()
    rows = lambda *r: spark.createDataFrame(r, "k string, v int")
    kept = catalogs.fresh_or_stale(rows(("a", 1)), rows(("a", 0), ("b", 0)), "k").collect()
    assert sorted(map(tuple, kept)) == [("a", 1, False), ("b", 0, True)]


def test_quadrangles(spark):
    def feature(quad, name, color, x):
        return {"properties": {"id_quad": quad, "name": name, "color": color}, "geometry": {"coordinates": [box(x - 0.02, -8.56, x + 0.02, -8.54)]}}

    rows = [feature(7, "one", "Green", -37.2968741), feature(7, "two", "#9acd32", -37.2968741), feature(8, "other", "red", -36.0)]
    got = catalogs.quadrangles(documents(spark, {"type": "FeatureCollection", "features": rows})).collect()
    assert [(r["portal_id"], r["municipality"], r["color"]) for r in got] == [("7", "one", "green")] and got[0]["sheet"].startswith("SC-24-X-B-IV-1-NE")
    with pytest.raises(Exception, match="conflict"):
        catalogs.quadrangles(documents(spark, {"type": "FeatureCollection", "features": [rows[0], feature(9, "two", "green", -37.2968741)]})).collect()
    with pytest.raises(Exception, match="no feature collection"):
        catalogs.quadrangles(documents(spark, {"features": rows})).collect()


def test_products_releases_and_audits(spark):
    value = lambda k, v: {"Id": k, "Attributes": [{"Name": "dataset", "Value": v}]}
    found = documents(spark, {"value": [value("old-id", "x/2023_1"), value("latest-z", "x/2024_1"), value("latest-a", "x/2024_1"), {"Id": "bare", "Attributes": []}]}, {"value": []})
    assert [r["product_id"] for r in catalogs.latest_products(found, "url").collect()] == ["latest-a"]
    config = {"10": {"itemTitle": "World Imagery (Wayback 2014-02-20)"}, "11": {"itemTitle": "none"}}
    assert [(r["version"], str(r["date"])) for r in catalogs.releases(documents(spark, config)).collect()] == [("10", "2014-02-20")]
    target = lambda k, x: {"region_id": k, "bounds": [x, 0, 1, 1], "crs": "c"}
    unit = {"workunit": "w", "project": "p", "lpc_link": "l", "collect_end": "2020"}
    audit = [unit | {"targets": [target("AL__1", 0), target("GA__1", 0)]}, unit | {"targets": [target("AL__1", 5), target("AL__2", 0)]}, unit | {"workunit": "v", "targets": [target("GA__1", 0)]}]
    got = catalogs.audits(documents(spark, audit), ["AL"]).collect()
    assert [(r["workunit"], [(t["region_id"], t["bounds"][0]) for t in r["targets"]]) for r in got] == [("w", [("AL__1", 5.0), ("AL__2", 0.0)])]
    assert catalogs.audits(documents(spark, audit)).count() == 2


def test_archives(spark, tmp_path):
    assert archives.elevation_member(["a/PREVIEW/x_DEM.tif", "a/b/T1_DEM.tif", "a/T1_DEM.TIF", "DEM.tif"], "t1") == "a/T1_DEM.TIF"
    assert archives.sheet_members(["x/MDT_S1.TIF", "../mdt_s1.tfw", "MDT_S10.tif"], "MDT_S1", ".tif", (".tfw", ".prj")) == [("../mdt_s1.tfw", "MDT_S1.tfw"), ("x/MDT_S1.TIF", "MDT_S1.tif")]
    for names in (["S1.tif", "d/s1.TIF"], ["S1.tfw"]):
        with pytest.raises(ValueError):
            archives.sheet_members(names, "S1", ".tif", (".tfw",))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("../S1.tif", b"pixels")
        z.writestr("S1.tfw", b"world")
    (tmp_path / "b.zip").write_bytes(b"no archive")
    frame = spark.createDataFrame([("S1", str(tmp_path / "a.zip")), ("S2", str(tmp_path / "b.zip")), ("S3", str(tmp_path / "a.zip"))], "key string, archive string")
    out = tmp_path / "out"
    got = {r["key"]: r for r in archives.extract(frame, str(out), "sheet", sidecars=(".tfw",)).collect()}
    assert sorted(os.listdir(out)) == ["S1.tfw", "S1.tif"] and (out / "S1.tif").read_bytes() == b"pixels"
    assert got["S1"]["error"] is None and got["S2"]["error"] and got["S3"]["error"]


class Handler(http.server.BaseHTTPRequestHandler):
    body, seen = bytes(range(256)) * 40, []

    def do_GET(self):
        asked = self.headers.get("Range")
        self.seen.append((self.path, asked))
        tries = sum(p == self.path for p, _ in self.seen)
        if self.path == "/gone":
            return self.send_error(404)
        if self.path == "/flaky" and tries < 3:
            return self.send_error(503)
        first = int(asked[6:-1]) if asked and self.path != "/whole" else 0
        if first >= len(self.body):
            self.send_response(416)
            self.send_header("Content-Range", f"bytes */{len(self.body)}")
            return self.end_headers()
        self.send_response(206 if first else 200)
        self.send_header("Content-Type", "text/html" if self.path == "/page" else "application/octet-stream")
        if first:
            self.send_header("Content-Range", f"bytes {first}-{len(self.body) - 1}/{len(self.body)}")
        self.send_header("Content-Length", str(len(self.body) - first))
        self.end_headers()
        cut = self.path == "/cut" and tries == 1
        self.wfile.write(self.body[first : len(self.body) // 2 if cut else None])

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    Handler.seen = []
    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler) as s:
        threading.Thread(target=s.serve_forever, daemon=True).start()
        yield f"http://127.0.0.1:{s.server_port}"
        s.shutdown()


def test_fetch(server, tmp_path):
    waits = []
    get = functools.partial(download.fetch, delay=2.0, sleep=waits.append)
    for name in ("flaky", "cut", "whole", "done"):
        if name in ("whole", "done"):
            (tmp_path / f"{name}.part").write_bytes(Handler.body[: 100 if name == "whole" else None])
        get(f"{server}/{name}", str(tmp_path / name))
        assert (tmp_path / name).read_bytes() == Handler.body
    assert waits == [2.0, 4.0, 2.0] and ("/cut", f"bytes={len(Handler.body) // 2}-") in Handler.seen
    for name in ("gone", "page"):
        with pytest.raises(download.Unfit):
            get(f"{server}/{name}", str(tmp_path / name))
    assert len(waits) == 3 and not any(n.endswith(".part") for n in os.listdir(tmp_path))


def test_download_and_command_line(server, spark, tmp_path, capsys, monkeypatch):
    rows = spark.createDataFrame([(f"{server}/{n}", f) for n, f in (("a", "a.bin"), ("gone", "b.bin"), ("c", "../c"), ("d", None))], "url string, filename string")
    out = download.download(rows, str(tmp_path), retries=0)
    assert {r["filename"]: r["status"] for r in out.collect()} == {"a.bin": "success", "b.bin": "failed", "../c": "failed", None: "failed"}
    assert {r["status"] for r in out.where("filename = 'a.bin'").collect()} == {"skipped"}
    base = {"region": {"class_path": "geoloom.components.BoxRegions", "init_args": {"source": {"r1": [0.1, 0.1, 0.2, 0.2], "r2": [0.15, 0.1, 0.3, 0.2]}}}, "pipelines": [{"name": "tiles", "source": {"class_path": "geoloom.components.XyzTiles", "init_args": {"url_template": server + "/{z}/{x}/{y}", "zoom": 8}}, "acquire": {"output_dir": "tiles", "max_workers": 4, "retry_delay": 0}, "postprocess": [{"class_path": "geoloom.components.PassThrough"}]}]}
    (tmp_path / "base.yaml").write_text(json.dumps(base))
    monkeypatch.chdir(tmp_path)
    assert cli.main(["-c", "base.yaml", "--check"]) == 0 and "2 of them" in capsys.readouterr().out
    assert not (tmp_path / "tiles").exists()
    assert cli.main(["-c", "base.yaml", "--set", "pipelines.tiles.acquire.max_workers=2"]) == 0
    assert '"complete": 2' in capsys.readouterr().out and os.listdir(tmp_path / "tiles") == ["tile_z8_x128_y127.jpg"]
    _, (pipeline,) = components.from_settings(base)
    boxes = components.BoxRegions(base["region"]["init_args"]["source"]).regions(spark)
    assets, _ = pipeline.run(spark, boxes, str(tmp_path))
    assert sorted((r["region_id"], r["status"]) for r in assets.collect()) == [("r1", "skipped"), ("r2", "skipped")]


def test_settings(tmp_path):
    base = {"a": {"x": 1, "y": [1]}, "pipelines": [{"name": "p", "s": {"class_path": "A", "k": 1}, "postprocess": [{"n": 1}, {"n": 2}]}, {"name": "q"}]}
    over = {"a": {"y": []}, "pipelines": [{"name": "r"}, {"name": "p", "s": {"class_path": "B"}, "postprocess": [{"m": 3}]}]}
    assert settings.layer(base, over) == {"a": {"x": 1, "y": []}, "pipelines": [{"name": "p", "s": {"class_path": "B"}, "postprocess": [{"n": 1, "m": 3}, {"n": 2}]}, {"name": "q"}, {"name": "r"}]}
    assert settings.layer(base, {"pipelines": [{"name": "p", "s": {"class_path": "A", "j": 2}, "postprocess": []}]})["pipelines"][0] == {"name": "p", "s": {"class_path": "A", "k": 1, "j": 2}, "postprocess": []}
    assert settings.set_value(base, "pipelines.p.postprocess.1.n=[4]")["pipelines"][0]["postprocess"][1] == {"n": [4]}
    assert base["pipelines"][0]["postprocess"][1] == {"n": 2}
    for wrong in ("a.z=1", "pipelines.none.s=1", "a.x.b=1", "a..x=1", "a.x", "pipelines.p=1", "a.y.7=1"):
        with pytest.raises(ValueError):
            settings.set_value(base, wrong)
    for wrong in ([{"name": "p"}, {"name": "p"}], [{"s": 1}]):
        with pytest.raises(ValueError):
            settings.layer(base, {"pipelines": wrong})
    with pytest.raises(ValueError):
        settings.build({"class_path": "geoloom.components.PassThrough"}, components.Source)
    with pytest.raises(ValueError):
        settings.build({"class_path": "geoloom.components.PassThrough", "init_args": {"other": 1}}, components.Step)
    with pytest.raises(ValueError):
        components.Pipeline("p", components.XyzTiles("{x}{y}{z}", 1), [components.OnlyProducts(["dsm"])])
    assert settings.output_folder(None, ["/a/1.tif", "/a/2.tif"], "/w") == "/a" and settings.output_folder(None, [None], "/w") == "/w/output"
    for mixed in (["/a/1.tif", "/b/2.tif"], ["/a/1.tif", None]):
        with pytest.raises(ValueError):
            settings.output_folder(None, mixed, "/w")
    assert settings.output_folder("o", ["/a/1.tif", "/b/2.tif"], "/w") == "/w/o"


def lzw(raw):
    """A plain encoder: a clear code ahead, codes widened one entry early."""
    table = {bytes([k]): k for k in range(256)}
    bits, size, word = f"{256:09b}", 258, b""
    for byte in raw:
        if word + bytes([byte]) in table:
            word += bytes([byte])
            continue
        bits += f"{table[word]:0{max(9, min(12, size.bit_length()))}b}"
        table[word + bytes([byte])] = size
        size += 1
        word = bytes([byte])
        if size == 4094:
            bits += f"{table[word]:012b}{256:012b}"
            table, size, word = {bytes([k]): k for k in range(256)}, 258, b""
    if word:
        bits += f"{table[word]:0{max(9, min(12, size.bit_length()))}b}"
        size += 1
    bits += f"{257:0{max(9, min(12, size.bit_length()))}b}"
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8)


def test_lzw():
    rng = np.random.default_rng(1)
    for raw in (b"", b"a", b"aaaaaaa" * 90, rng.integers(0, 3, 20000).astype(np.uint8).tobytes(), rng.integers(0, 256, 9000).astype(np.uint8).tobytes()):
        assert geotiff.unpack_lzw(lzw(raw)) == raw


@pytest.mark.parametrize("predictor", [1, 2])
def test_striped_big_endian_tiff(spark, tmp_path, predictor):
    """Three bands together, strips of two rows of which the last is short."""
    pixels = np.arange(5 * 4 * 3, dtype=np.uint16).reshape(5, 4, 3) * 999
    stored = np.diff(pixels, axis=1, prepend=np.zeros((5, 1, 3), np.uint16)) if predictor == 2 else pixels
    strips = [lzw(stored[k : k + 2].astype(">u2").tobytes()) for k in (0, 2, 4)]
    at = 8 + np.concatenate([[0], np.cumsum([len(s) for s in strips])])
    ifd = int(at[-1])
    data = b"".join([struct.pack(">3I", *at[:3]), struct.pack(">3I", *map(len, strips)), struct.pack(">3H", 16, 16, 16)])
    spare = ifd + 2 + 12 * 9 + 4
    entries = [(256, 3, 1, 4 << 16), (257, 3, 1, 5 << 16), (258, 3, 3, spare + 24), (259, 3, 1, 5 << 16), (273, 4, 3, spare), (277, 3, 1, 3 << 16), (278, 3, 1, 2 << 16), (279, 4, 3, spare + 12), (317, 3, 1, predictor << 16)]
    path = tmp_path / "s.tif"
    path.write_bytes(b"MM\0*" + struct.pack(">I", ifd) + b"".join(strips) + struct.pack(">H", 9) + b"".join(struct.pack(">HHII", *e) for e in entries) + b"\0\0\0\0" + data)
    spark.dataSource.register(geotiff.GeoTiffSource)
    got = spark.read.format("geotiff_cells").option("band", 2).load(str(path)).collect()
    assert {(r["row"], r["col"]): r["value"] for r in got} == {(r, c): float(pixels[r, c, 1]) for r in range(5) for c in range(4)}
    with pytest.raises(Exception, match="no band 4"):
        spark.read.format("geotiff_cells").option("band", 4).load(str(path)).collect()


def test_rasters_from_cells(spark, tmp_path):
    rows = [("a", r, c, float(r * 300 + c)) for r in range(3) for c in range(300) if c != 7] + [("a", 9, 0, 1.0), ("a", 0, -1, 1.0), ("a", 1, 7, None)]
    cells = spark.createDataFrame(rows, "raster_id string, row int, col int, value double")
    places = spark.createDataFrame([("a", 300, 3, 10.0, 22.4, 0.5, 32610), ("b", 2, 2, 0.0, 0.0, 1.0, 4326), ("c", 1 << 20, 1 << 20, 0.0, 0.0, 1.0, None)], "raster_id string, width int, height int, left double, top double, pixel double, epsg int")
    got = {r["raster_id"]: r for r in rasters.write_cells(cells, places, str(tmp_path), "_dsm").collect()}
    assert (got["a"]["valid"], got["b"]["valid"], got["c"]["path"]) == (897, 0, None) and got["c"]["error"]
    spark.dataSource.register(geotiff.GeoTiffSource)
    back = spark.read.format("geotiff_cells").load(str(tmp_path / "a_dsm.tif")).where("value is not null")
    assert sorted((r["row"], r["col"], r["value"]) for r in back.collect()) == sorted(r[1:] for r in rows[:897])
    regions = rasters.raster_regions(listing.folder(spark, str(tmp_path))).orderBy("region_id").collect()
    assert [(r["region_id"], r["minx"], r["maxy"], r["maxx"], r["crs"], r["width"]) for r in regions] == [("a_dsm", 10.0, 22.4, 160.0, "EPSG:32610", 300), ("b_dsm", 0.0, 0.0, 2.0, "EPSG:4326", 2)]


def png(path, pixels):
    chunk = lambda kind, raw: struct.pack(">I", len(raw)) + kind + raw + struct.pack(">I", zlib.crc32(kind + raw))
    high, wide, _ = pixels.shape
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">2I5B", wide, high, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_map_tiles(spark, tmp_path):
    pixels = np.random.default_rng(2).integers(0, 256, (16, 16, 3)).astype(np.uint8)
    images = tmp_path / "images"
    images.mkdir()
    png(images / "tile_z2_x1_y2.png", pixels)
    png(images / "nowhere.png", pixels)
    read = spark.read.format("image").load(str(images))
    got = {r["raster_id"]: r for r in rasters.write_tiles(read, str(tmp_path / "out")).collect()}
    assert got["nowhere"]["error"] and got["tile_z2_x1_y2"]["error"] is None
    path = got["tile_z2_x1_y2"]["path"]
    head = geotiff.read_header(path)
    side = 20037508.342789244 / 2
    assert head.crs == "EPSG:3857" and head.bands == 3 and head.bounds == pytest.approx((-side, -side, 0.0, 0.0), abs=1e-6)
    spark.dataSource.register(geotiff.GeoTiffSource)
    for band in (1, 2, 3):
        back = spark.read.format("geotiff_cells").option("band", band).load(path).collect()
        assert {(r["row"], r["col"]): r["value"] for r in back} == {(r, c): float(pixels[r, c, band - 1]) for r in range(16) for c in range(16)}
