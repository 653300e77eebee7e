"""Queries of the name parsers: names made from numbers, and what the numbers say, as SQL that never reads a name.

Each template makes a name from the columns of the names fixture; the expectation says x, y and the zone's code by the rule of the delivery,
from the same columns as numbers (A to D), the running number k and the quadrant q. Every fiftieth name is one that no parser reads.
"""

from __future__ import annotations

from dataclasses import dataclass

LETTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ"


@dataclass(frozen=True)
class Case:
    name: str  # SQL that both engines run
    x: str
    y: str
    epsg: str = "NULL"
    good: str = "true"


def _letter(letters: str, k: str = "k") -> str:
    return f"substr('{letters}', cast({k} % {len(letters)} + 1 as int), 1)"


def _within(v: str) -> str:
    return f"floor(({v}) / 2500.0 + 0.5) * 2500"


def _up(v: str, step: int) -> str:
    return f"ceil(({v}) / {step}.0) * {step}"


def _florida() -> tuple[str, str, str]:
    # Offset, cells, columns, left and top of the three zones.
    zones = {"E": (200000, 150000, 300, -330000, 2500000), "W": (400000, 150000, 300, 0, 2500000), "N": (600000, 108000, 540, 850000, 970000)}
    number = "(C * 1000 + D)"
    picks = {"x": [], "y": [], "good": []}
    for zone, (offset, cells, columns, left, top) in zones.items():
        named = {"E": "false", "W": "k % 3 = 0", "N": "k % 3 = 1"}[zone]
        index = f"(CASE WHEN {number} > {offset} THEN {number} - {offset} WHEN {named} THEN {number} ELSE 0 END)"
        fits = f"({named} OR k % 3 = 2) AND {index} BETWEEN 1 AND {cells}"
        picks["x"].append(f"WHEN {fits} THEN {left} + (({index} - 1) % {columns}) * 5000")
        picks["y"].append(f"WHEN {fits} THEN {top} - (({index} - 1) // {columns} + 1) * 5000")
        picks["good"].append(fits)
    case = lambda what: f"CASE {' '.join(picks[what])} END"
    return case("x"), case("y"), " OR ".join(f"({g})" for g in picks["good"])


def _mgrs(digits: str, e: str, n: str) -> dict[str, str]:
    """The parts of references whose letters run with k: columns repeat every three zones, rows start anew in even zones."""
    sets = "(CASE (k % 62) % 3 WHEN 1 THEN 'ABCDEFGH' WHEN 2 THEN 'JKLMNPQR' ELSE 'STUVWXYZ' END)"
    column = f"instr({sets}, {_letter(LETTERS)})"
    base = "(((k % 20) - CASE WHEN (k % 62) % 2 = 0 THEN 5 ELSE 0 END + 20) % 20 * 100000)"
    # The least northings of the bands from C on.
    least = "[1100000, 2000000, 2800000, 3700000, 4600000, 5500000, 6400000, 7300000, 8200000, 9100000, 0, 800000, 1700000, 2600000, 3500000, 4400000, 5300000, 6200000, 7000000, 7900000][(k % 20 + 1)::int]"
    square = f"({base} + greatest(0, ceil(({least} - {base}) / 2000000.0)) * 2000000)"
    name = f"concat('t_', cast(k % 62 as string), {_letter('CDEFGHJKLMNPQRSTUVWX')}, {_letter(LETTERS)}, {_letter('ABCDEFGHJKLMNPQRSTUV')}, {digits}, '.laz')"
    return {"name": name, "column": column, "easting": f"({column} * 100000 + {e} * 1000)", "square": square, "northing": f"({square} + {n} * 1000)", "epsg": "(CASE WHEN k % 20 >= 10 THEN 32600 ELSE 32700 END + k % 62)", "good": f"k % 62 BETWEEN 1 AND 60 AND {column} > 0"}


_plain = _mgrs("a", "(A // 100)", "(A % 100)")
_zeros = _mgrs("lpad(cast(k % 3 as string), 2, '0'), substr(a, 3, 2)", "(k % 3)", "(A % 100)")
_fl_x, _fl_y, _fl_good = _florida()
_wide, _long = "concat('t_', c, d, '_19.laz')", "concat('t_', a, b, '_LAS_2018.laz')"
_twelve = "concat('t_', a, c, b, '9.laz')"
_east, _north = "CASE WHEN q LIKE '%E' THEN {} ELSE 0 END", "CASE WHEN q LIKE 'N%' THEN {} ELSE 0 END"
_wrap = "(C * 1000 + CASE WHEN C < 500 THEN 1000000 ELSE 0 END)"


def _panel(size: int, columns: int, first: int) -> Case:
    name, cell = "concat('t_LA_37_', a, substr(b, 1, 2), substr(d, 2, 2), '_LAS_2018.laz')", f"(D % 100 - {first})"
    x, y = "((A // 1000 * 100 + A // 10 % 10 * 10 + B // 1000) * 10000", "((A // 100 % 10 * 100 + A % 10 * 10 + B // 100 % 10) * 10000"
    return Case(name, f"{x} + {cell} % {columns} * {size})", f"{y} + ({columns - 1} - {cell} // {columns}) * {size})", good=f"{cell} >= 0 AND {cell} < {columns * columns}")


_odd = "(CASE WHEN {0} % 10 = 0 THEN {0} // 10 ELSE {0} END)"
_savannah = ("(A // 1000 * 1000 + A // 10 % 10 * 100 + B // 1000 * 10 + B // 10 % 10) * 1000", "(A // 100 % 10 * 1000 + A % 10 * 100 + B // 100 % 10 * 10 + B % 10) * 1000")
_savannah_name = "concat('t_', a, b, '_17.laz')"

CASES: dict[str, Case] = {
    "full_xy": Case("concat('t_', c, d, a, c, '.las')", "C * 1000 + D", "A * 1000 + C"),
    "axis_pair": Case("concat('t_E', a, 'N', b, '.laz')", "A", "B"),
    "axis_named_pair": Case("concat('t_N', a, '_w', b, '.laz')", "B", "A"),
    "axis_suffix_pair": Case("concat('t_', a, 'E_', b, 'N_LAS_2019.laz')", "A", "B"),
    "number_pair": Case("concat('t_', a, '_', b, '.laz')", "A", "B"),
    "number_pair_date": Case("concat('t_', a, '55_', b, '44_20210703.laz')", "A * 100 + 55", "B * 100 + 44"),
    "odd_km_pair": Case("concat('t_', a, b, '.laz')", f"{_odd.format('A')} * 1000", f"{_odd.format('B')} * 1000", good=f"{_odd.format('A')} % 2 = 1 AND {_odd.format('B')} % 2 = 1"),
    "ct_quadrant_2500ft": Case("concat('t_', c, d, '_', q, '.laz')", f"{_wrap} + {_east.format(2500)}", f"D * 1000 + {_north.format(2500)}"),
    "fl_fdem_5000ft": Case("concat('t_', c, d, case when k % 3 = 0 then '_W' when k % 3 = 1 then '_0903' else '' end, '.laz')", _fl_x, _fl_y, good=_fl_good),
    "ca_solano_2640ft": Case("concat('t_', a, '7E', b, '3N.laz')", f"{_up('(A * 10 + 7) * 100 - 400', 2640)} + 400", f"{_up('(B * 10 + 3) * 100 - 2560', 2640)} + 2560"),
    "mn_utm_pair": Case("concat('t_', case when k % 2 = 0 then c else a end, '_', a, case when k % 2 = 0 then '' else '5' end, '.laz')", "CASE WHEN k % 2 = 0 THEN C * 1000 ELSE A * 100 END", "CASE WHEN k % 2 = 0 THEN A * 1000 ELSE A * 1000 + 500 END"),
    "nj_5000ft": Case(
        f"concat('t_', {_letter('ABCDEFGHIJKL')}, cast(k % 26 as string), {_letter('ABCD')}, cast(k % 18 as string), '.laz')",
        "190000 + k % 12 * 40000 + CASE WHEN k % 4 IN (1, 3) THEN 20000 ELSE 0 END + (k % 18 - 1) % 4 * 5000", "925000 - (k % 26 - 1) * 40000 - CASE WHEN k % 4 IN (2, 3) THEN 20000 ELSE 0 END - ((k % 18 - 1) // 4 + 1) * 5000", good="k % 26 BETWEEN 1 AND 23 AND k % 18 BETWEEN 1 AND 16",
    ),
    "tn_7000x4000ft": Case("concat('t_', a, c, q, '.laz')", f"A * 1000 + 503 + {_east.format(7000)}", f"C * 1000 + 378 + {_north.format(4000)}"),
    "vt_1400m_legacy_center": Case("concat('t_N', cast(1001 + 14 * (k % 400) as string), 'E', c, '.laz')", "(1001 + 14 * (k % 400)) * 100", "C * 100 + CASE (C - 7) % 14 WHEN 0 THEN 0 WHEN 8 THEN 100000 ELSE 200000 END", good="(C - 7) % 14 IN (0, 2, 8)"),
    "zone_full_xy": Case("concat('t_18TXY00000', a, '00000', b, '.laz')", "A", "B"),
    "pa_luzerne_2500ft": Case("concat('t_', case when k % 2 = 0 then '2' else '' end, a, b, '.laz')", "2000000 + A * 100", "B * 100"),
    "pa_dauphin_5000ft": Case("concat('t_', a, b, 'PAS.laz')", "B * 1000", "A * 100"),
    "letter_row_number_column": Case(f"concat('t_', {_letter('ABCDEFGHIJKL')}, case when k % 2 = 0 then 'q' else '' end, c, '.laz')", "C", "CASE WHEN k % 2 = 0 THEN (k % 12 + 1) * 26 + 16 ELSE k % 12 END"),
    "sc_5000ft_quadrants": Case("concat('t_', a, '_0', cast(k % 6 as string), '.laz')", "(A // 1000 * 10 + A // 10 % 10) * 10000 + CASE WHEN k % 6 IN (2, 4) THEN 5000 ELSE 0 END", "(A // 100 % 10 * 10 + A % 10) * 10000 + CASE WHEN k % 6 IN (1, 2) THEN 5000 ELSE 0 END", good="k % 6 BETWEEN 1 AND 4"),
    "sc_savannah_5000ft": Case(_savannah_name, *_savannah),
    "sc_savannah_2500ft": Case(_savannah_name, *map(_within, _savannah)),
    "wi_sewrpc_10kft": Case("concat('t_LD15_', a, '_', c, '.laz')", "A * 1000", "C * 1000"),
    "wi_2500ft_quadrants": Case(
        "concat('t_', a, b, case when k % 2 = 0 then q else '' end, '.laz')", f"CASE WHEN k % 2 = 0 THEN A * 1000 + {_east.format(2500)} ELSE {_up('A * 1000', 2500)} END", f"CASE WHEN k % 2 = 0 THEN B * 1000 + {_north.format(2500)} ELSE {_up('B * 1000', 2500)} END", good="k % 2 = 1 OR A % 5 = 0 AND B % 5 = 0"
    ),
    "wa_thurston_4500ft": Case("concat('t_w', a, '0n', b, '5.laz')", "A * 10 * CASE WHEN A * 10 >= 90000 THEN 10 ELSE 100 END", "(B * 10 + 5) * 10"),
    "mgrs": Case(_plain["name"], _plain["easting"], _plain["northing"], _plain["epsg"], _plain["good"]),
    "mgrs_tokens": Case(_plain["name"], "A // 100", "A % 100", _plain["epsg"], _plain["good"]),
    "mgrs_absolute_tokens": Case(_plain["name"], "A // 100 * 10000", f"floor({_plain['square']} / 1000000) * 1000000 + A % 100 * 10000", _plain["epsg"], _plain["good"]),
    "mgrs_zero_x_next_100km": Case(_zeros["name"], f"{_zeros['easting']} + CASE WHEN k % 3 = 0 THEN 100000 ELSE 0 END", _zeros["northing"], _zeros["epsg"], _zeros["good"]),
    "mgrs_zero_x_columns_tu": Case(_zeros["name"], f"{_zeros['easting']} + CASE WHEN k % 3 = 0 AND {_letter(LETTERS)} IN ('T', 'U') THEN 100000 ELSE 0 END", _zeros["northing"], _zeros["epsg"], _zeros["good"]),
    "mgrs_zone14_legacy_columns": Case(f"concat('t_14', {_letter('RSTU')}, {_letter('JKLMNOPQ')}, 'V', a, '.laz')", "(k % 8 + 1) * 100000 + A // 100 * 1000", "CASE WHEN k % 4 = 0 THEN 3400000 ELSE 5400000 END + A % 100 * 1000", "32614"),
    "mgrs_separated_xy": Case(f"concat('t_13S_', {_letter('ABCDEFGH')}, 'R_', a, '1_', b, '7.laz')", "(k % 8 + 1) * 100000 + A * 10 + 1", "3500000 + B * 10 + 7", "32613"),
    "id_southern_15": Case("concat('t_11T', case when k % 3 = 0 then 'TM470965' when k % 3 = 1 then 'TM470980' else concat('NH00', substr(a, 1, 2)) end, '.laz')", "CASE WHEN k % 3 < 2 THEN 747000 ELSE 600000 END", "CASE k % 3 WHEN 0 THEN 4696500 WHEN 1 THEN 4698000 ELSE 4700000 + A // 100 * 1000 END", "32611"),
    "mgrs_zone_11": Case("concat('USGS_LPC_10SKA', a, case when k % 2 = 0 then '_LAS_2019' else '' end, '.laz')", "200000 + A // 100 * 1000", "4000000 + A % 100 * 1000", "32611"),
    "tx_lower_rio_500m": Case(f"concat('t_14RPV', a, '_', {_letter('abcde')}, '.laz')", "700000 + A // 100 * 1000 + CASE WHEN k % 5 IN (1, 2) THEN 500 ELSE 0 END", "3400000 + A % 100 * 1000 + CASE WHEN k % 5 IN (0, 1) THEN 500 ELSE 0 END", "32614", "k % 5 < 4"),
    "mgrs_fixed_16s": Case(f"concat('t_', {_letter('ABCDEFGH')}, 'C_', a, '.laz')", "(k % 8 + 1) * 100000 + A // 100 * 1000", "3700000 + A % 100 * 1000"),
    "zone_tokens": Case("concat('t_17RLM', a, c, '8.laz')", "A", "C * 10 + 8"),
    "zone_tokens_grid_lm": Case("concat('t_17R', case when k % 2 = 0 then 'LM' else 'KL' end, a, c, '8.laz')", "A", "C * 10 + 8", good="k % 2 = 0"),
    "ca_eldorado_2500ft": Case("concat('t_10SEH', c, d, '.laz')", "C * 1000 + CASE WHEN C >= 500 THEN 6000000 ELSE 7000000 END", "D * 1000 + CASE WHEN D >= 500 THEN 1000000 ELSE 2000000 END"),
    "il_mchenry_2500ft": Case(_long, "A * 100 + CASE WHEN A * 100 < 500000 THEN 1000000 ELSE 0 END", "B * 100 + 2000000"),
    "nh_2500ft": Case(_long, "A * 100 + CASE WHEN A * 100 < 500000 THEN 1000000 ELSE 0 END", "B * 100"),
    "az_eastern_pima_5k": Case(_wide, _wrap, "D * 1000"),
    "mt_1000m_wrapped": Case(_wide, _wrap, "D * 1000"),
    "ca_san_diego_5k": Case(_wide, "C * 1000 + 6000000", "D * 1000 + CASE WHEN D < 500 THEN 2000000 ELSE 1000000 END"),
    "mi_2500ft": Case(_wide, _within("C * 1000"), _within("D * 1000")),
    "mi_2500ft_wrapped": Case(_wide, _within(_wrap), _within("D * 1000")),
    "single_number_split_3": Case(_wide, "C", "D"),
    "single_number_split_4": Case(_long, "A", "B"),
    "single_number_split_5": Case(_twelve, "A * 10 + C // 100", "C % 100 * 100000 + B * 10 + 9"),
    "single_number_split_6": Case(_twelve, "A * 100 + C // 10", "C % 10 * 100000 + B * 10 + 9"),
    "single_number_split_7": Case(_twelve, "A * 1000 + C", "B * 10 + 9"),
    "nc_panel_5000ft": _panel(5000, 2, 1),
    "nc_panel_2500ft": _panel(2500, 4, 5),
    "nc_panel_1250ft": _panel(1250, 8, 21),
}


def named(case: Case) -> str:
    return f"case when k % 50 = 49 then concat('odd-', a) else {case.name} end"


def oracle(case: Case) -> str:
    """The names and what they mean; {names} stands for the fixture. Upper-case letters are the columns as numbers."""
    name = named(case).replace("as string", "as varchar")
    said = lambda v: f"CASE WHEN k % 50 <> 49 AND ({case.good}) THEN {v} END"
    number = ", ".join(f"try_cast({c} AS bigint) AS n_{c}" for c in "abcd")
    sql = lambda v: _numbers(said(v))
    return f"WITH n AS (SELECT *, {name} AS filename, {number} FROM {{names}}) SELECT k, filename, cast({sql(case.x)} AS double) AS x, cast({sql(case.y)} AS double) AS y, cast({sql(case.epsg)} AS int) AS epsg FROM n"


def _numbers(text: str) -> str:
    """A to D, where they stand alone, as the number columns."""
    import re

    return re.sub(r"(?<!['\w])([ABCD])(?!['\w])", lambda m: f"n_{m[1].lower()}", text)
