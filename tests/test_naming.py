"""Rule catalogues and the tiles that they plan."""

import copy

import pytest

from geoloom.operators import naming

GRID = {"x_scale": 1, "y_scale": 1, "x_offset": 0, "y_offset": 0, "x_anchor": "min", "y_anchor": "min", "width": 1000, "height": 1000}
RAW = {
    "version": 1,
    "projects": [
        {"name": "hi", "match": {"workunit": "^HI_"}, "schemes": [{"parser": "mgrs", "crs": "workunit", "grid": GRID}]},
        {"name": "wv", "match": {"workunit": "^WV_", "project": "ohio"}, "schemes": [{"parser": "axis_pair", "crs": "EPSG:26917", "naming": "axes", "grid": GRID | {"x_scale": 1000, "y_scale": 1000}}, {"parser": "full_xy", "crs": "mgrs", "grid": GRID}, {"parser": "odd_km_pair", "crs": "mgrs", "grid": GRID}]},
        {"name": "pit", "match": {"workunit": "Pit"}, "schemes": [{"parser": "ca_upper_pit_5k", "crs": "EPSG:6416", "grid": GRID | {"width": 5000, "height": 5000}}]},
    ],
}
COLUMNS = "workunit string, project string, lpc_link string, horiz_crs string, filename string, x int"


def test_tiles_by_rules(spark):
    rows = [
        ("HI_1", None, "l", "6635", "USGS_5QKC250180.laz", 1),
        ("HI_2", None, "l", "103001", "USGS_5QKC250180.laz", 2),
        ("HI_3", None, "l", None, "USGS_5QKC250180.laz", 3),
        ("WV_1", "Ohio", "l", None, "t_E1234N5678.laz", 4),
        ("WV_1", "Ohio", "l", None, "t_8970_1001.laz", 5),
        ("WV_1", "other", "l", None, "t_E1234N5678.laz", 6),
        ("HI_1", None, "l", "6635", "nothing.laz", 7),
        (None, None, None, None, None, 8),
    ]
    planned = naming.plan_tiles(spark.createDataFrame(rows, COLUMNS), naming.parse_rules(RAW))
    got = {r["x"]: r for r in planned.collect()}
    assert len(got) == 8
    box = lambda k: tuple(got[k][s] for s in ("minx", "miny", "maxx", "maxy", "tile_crs", "naming"))
    assert box(1) == (225000, 2218000, 226000, 2219000, "EPSG:6635", "mgrs") and got[2]["tile_crs"] == "ESRI:103001"
    assert box(4) == (1234000, 5678000, 1235000, 5679000, "EPSG:26917", "axes")
    assert [(k, got[k]["rule"], got[k]["no_system"]) for k in (3, 5, 6, 7, 8)] == [(3, "hi", True), (5, "wv", True), (6, None, False), (7, "hi", False), (8, None, False)]
    assert all(got[k]["minx"] is None for k in (3, 5, 6, 7, 8))
    audit = {r["workunit"]: (r["status"], r["files"], r["tiles"], r["unread"], r["examples"]) for r in naming.audit(planned.where("x in (1, 2, 3, 7)")).collect()}
    assert audit == {"HI_1": ("partial", 2, 1, 1, ["nothing.laz"]), "HI_2": ("matched", 1, 1, 0, []), "HI_3": ("unmatched", 1, 0, 1, ["USGS_5QKC250180.laz"])}
    assert naming.plan_tiles(spark.createDataFrame([], COLUMNS), naming.parse_rules(RAW)).count() == 0
    both = copy.deepcopy(RAW)
    both["projects"][1]["match"] = {"lpc_link": "l"}
    with pytest.raises(Exception, match="several rules"):
        naming.plan_tiles(spark.createDataFrame(rows, COLUMNS), naming.parse_rules(both)).collect()


def test_wrong_rules():
    def changed(path, value):
        raw = copy.deepcopy(RAW)
        node = raw
        for part in path[:-1]:
            node = node[part]
        node[path[-1]] = value
        return raw

    scheme = ("projects", 0, "schemes", 0)
    for path, value in ((("version",), 2), (("projects", 0, "name"), ""), (("projects", 0, "match"), {}), (("projects", 0, "match"), {"other": "a"}), (("projects", 0, "schemes"), []), ((*scheme, "parser"), "single_number_split_8"), ((*scheme, "grid"), {"width": 1}), ((*scheme, "grid"), GRID | {"x_anchor": "left"}), ((*scheme, "grid"), GRID | {"height": 0}), ((*scheme, "grid"), GRID | {"x_ceil_step": 1, "x_round_step": 1})):
        with pytest.raises(ValueError):
            naming.parse_rules(changed(path, value))
