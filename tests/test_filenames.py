"""Names with known coordinates."""

import pytest

from geoloom.functions import crs, filenames

CASES = [
    ("a_19TCK388906.laz", "mgrs_absolute_tokens", 388000, 4906000),
    ("a_8970_1001.laz", "odd_km_pair", 897000, 1001000),
    ("a_8960_1002.laz", "odd_km_pair", None, None),
    ("a_00000000.laz", "il_mchenry_2500ft", 1000000, 2000000),
    ("a_479896_W.laz", "fl_fdem_5000ft", 475000, 1165000),
    ("a_251165_E.laz", "fl_fdem_5000ft", 490000, 1645000),
    ("a_647650_N.laz", "fl_fdem_5000ft", 1495000, 525000),
    ("a_050300_E.laz", "fl_fdem_5000ft", 665000, 1660000),
    ("a_318450_0901.laz", "fl_fdem_5000ft", 915000, 525000),
    ("a_20770404.laz", "nc_panel_5000ft", 2705000, 740000),
    ("a_20770416.laz", "nc_panel_2500ft", 2707500, 742500),
    ("a_20770460.laz", "nc_panel_1250ft", 2708750, 743750),
    ("a_A1A1.laz", "nj_5000ft", 190000, 920000),
    ("a_L23D16.laz", "nj_5000ft", 665000, 5000),
    ("a_H7B14.laz", "nj_5000ft", 495000, 665000),
    ("a_327_5191.laz", "mn_utm_pair", 327000, 5191000),
    ("a_5315_48935.laz", "mn_utm_pair", 531500, 4893500),
    ("a_240E_200N_LAS_2019.laz", "axis_suffix_pair", 240, 200),
    ("a_03300130NE.laz", "wi_2500ft_quadrants", 332500, 132500),
    ("a_04000162.laz", "wi_2500ft_quadrants", 400000, 162500),
    ("a_w10035n53100.laz", "wa_thurston_4500ft", 1003500, 531000),
    ("a_w99900n62550.laz", "wa_thurston_4500ft", 999000, 625500),
    ("a_5QKC250180.laz", "mgrs", 225000, 2218000),
    ("a_E1234N5678.laz", "axis_pair", 1234, 5678),
    ("a_13S_DR_78499_58000.laz", "mgrs_separated_xy", 478499, 3558000),
    ("a_40002190PAS.laz", "pa_dauphin_5000ft", 2190000, 400000),
    ("a_2248661NE.laz", "tn_7000x4000ft", 2255503, 665378),
    ("a_N4557E527.laz", "vt_1400m_legacy_center", 455700, 252700),
    ("a_A146.laz", "letter_row_number_column", 146, 0),
    ("a_AA7.laz", "letter_row_number_column", 7, 26),
    ("a_3431_02.laz", "sc_5000ft_quadrants", 335000, 415000),
    ("a_12345678.laz", "single_number_split_4", 1234, 5678),
    ("a_10SKA0102.laz", "mgrs_zone_11", None, None),
    ("no number", "number_pair", None, None),
]


@pytest.mark.parametrize("parser", sorted({c[1] for c in CASES}))
def test_known_names(spark, parser):
    cases = [c for c in CASES if c[1] == parser]
    rows = filenames.decode(spark.createDataFrame([(c[0],) for c in cases], "filename string"), parser).collect()
    if parser == "mgrs_zone_11":
        assert rows[0]["epsg"] == 32611
        return
    assert [(r["x"], r["y"]) for r in rows] == [(c[2], c[3]) for c in cases]


def test_corner_of_a_projected_grid(spark):
    """Names made from corners of the state plane grid lead back to them; a cell without a corner gives null."""
    names, want = ["a_10TFL000000.laz", "a_11TFL000000.laz", "a_10TFL0000.laz", "none.laz"], [(None, None)] * 4
    for x, y in ((6500000.0, 2200000.0), (6605000.0, 1995000.0), (6420000.0, 2345000.0)):
        east, north = (float(v) for v in crs.transform(x, y, "EPSG:6416", "EPSG:6339"))
        column, row = "ABCDEFGH"[int(east // 100000) - 1], "ABCDEFGHJKLMNPQRSTUV"[int(north // 100000 + 5) % 20]
        names.append(f"USGS_10T{column}{row}{int(east % 100000 // 100):03d}{int(north % 100000 // 100):03d}.laz")
        want.append((x, y))
    frame = spark.createDataFrame(list(enumerate(names)), "k int, filename string")
    assert [(r["x"], r["y"]) for r in filenames.decode(frame, "ca_upper_pit_5k").orderBy("k").collect()] == want
