"""Tile names to projected tokens, as column expressions.

A parser is a pattern with captures and, in a small SQL dialect that Spark and the tests' SQL engine share, a guard
and two coordinates over the captures. Everything compiles to built-in expressions, so a catalogue of names is decoded
inside one code-generated stage. A name that does not fit gives null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import crs

# Name formats and grid letters of the published naming schemes.
EXTENSION = r"(?i)(\.la[sz])+$"
MGRS = r"(?i)(\d{1,2})([C-HJ-NP-X])[_-]?([A-HJ-NP-Z]{2})[_-]?(\d{1,10})(?:[_-](\d{1,5}))?"
ZONE_TOKENS = r"(?i)(\d{1,2})[A-Z][_-]?([A-Z]{2})[_-]?(\d{2,10})"
FULL_XY = r"_(\d{5,6})(\d{7})$"
AXIS_PAIR = r"(?i)[_-]([A-Z])(\d{3,7})[_-]?([A-Z])(\d{3,7})(?:_(?:LAS_)?20\d{2})?$"
AXIS_SUFFIX = r"(?i)_(\d{3,7})E_(\d{3,7})N(?:_LAS_20\d{2})?$"
NUMBER_PAIR = r"(?i)_(\d{4,8})_(\d{4,8})(?:_[A-Z][A-Z0-9_-]*)?$"
DATED_PAIR = r"_(\d{6})_(\d{6})_(20\d{6})$"
LAST_NUMBER = r"(?i)(\d{6,12})(?:_(?:(?:LAS_)?20\d{2}|\d{2}))*[_-]*$"
ODD_KM = r"(?i)_(\d{4})_?(\d{4})(?:_LAS_20\d{2})?$"
CT_QUADRANT = r"(?i)_(\d{3})(\d{3})_(nw|ne|sw|se)$"
FL_INDEX = r"(?i)_(\d{6})(?:_(E|W|N|0901|0902|0903))?$"
SOLANO = r"(?i)_(\d{5})E(\d{5})N$"
MN_PAIR = r"_(\d{3,4})_(\d{4,5})$"
NJ_GRID = r"(?i)_([A-L])(\d{1,2})([A-D])(\d{1,2})$"
NC_PANEL = r"(?i)_(?:LA_37_)?(\d{8})(?:_+(?:(?:LAS_)?20\d{2}(?:\d{4})?(?:R\d+)?))*_*$"
MGRS_SEPARATED = r"(?i)_(\d{1,2})[_-]?([C-HJ-NP-X])[_-]([A-HJ-NP-Z]{2})[_-](\d{5})[_-](\d{5})$"
GRID_TOKEN = r"(?i)[_-]([A-Z]{2})[_-]?(\d{2,10})$"
TN_QUADRANT = r"(?i)_(\d{4})(\d{3})(NE|NW|SE|SW)(?:_LAS_20\d{2})?$"
ZONE_FULL_XY = r"(?i)_\d{1,2}[A-Z]{3}(\d{9})(\d{9})$"
LUZERNE = r"_(\d{8,9})$"
DAUPHIN = r"(?i)_(\d{4})(\d{4})PAS$"
LETTER_ROW = r"(?i)_([A-Z]{1,2})(\d{1,3})(?:_LAS_20\d{2})?$"
SC_QUADRANT = r"_(\d)(\d)(\d)(\d)[_-]0([1-4])$"
SC_SAVANNAH = r"_(\d{8})(?:_\d{2})?$"
SEWRPC = r"(?i)_LD15_(\d{4})_(\d{3})(?:_LAS_20\d{2})?$"
WI_QUADRANT = r"(?i)_(\d{4})(\d{4})(NE|NW|SE|SW)?$"
THURSTON = r"(?i)_w(\d{5})n(\d{5})$"
COLUMN_SETS = ("ABCDEFGH", "JKLMNPQR", "STUVWXYZ")
ROW_LETTERS = "ABCDEFGHJKLMNPQRSTUV"
BANDS = "CDEFGHJKLMNPQRSTUVWX"
BAND_LEAST = (1100000, 2000000, 2800000, 3700000, 4600000, 5500000, 6400000, 7300000, 8200000, 9100000, 0, 800000, 1700000, 2600000, 3500000, 4400000, 5300000, 6200000, 7000000, 7900000)


@dataclass(frozen=True)
class Dialect:
    """What the two engines write differently."""

    real: str
    half_even: str
    last_match: str  # of the struct list with fields g1, g2, ...
    letter: str  # number of a capital letter, A is 1


SPARK = Dialect("double", "rint({0})", "element_at({0}, -1)", "(ascii({0}) - 64)")
DUCKDB = Dialect("double", "round_even({0}, 0)", "list_extract({0}, -1)", "(ascii({0}) - 64)")


@dataclass(frozen=True)
class Parser:
    """@k is capture k, #k the same as a number; r(...) rounds half to even; l(...) numbers a letter."""

    pattern: str
    x: str
    y: str
    where: str = "true"


def _split(at: int, x: str = "{x}", y: str = "{y}", where: str = "true") -> Parser:
    left, right = f"n(substr(@1, 1, {at}))", f"n(substr(@1, {at + 1}))"
    fill = lambda text: text.replace("{x}", left).replace("{y}", right)
    return Parser(LAST_NUMBER, fill(x), fill(y), fill(f"{at} between 3 and 7 and length(@1) - {at} between 3 and 7 and {where}"))


def _wrap(value: str) -> str:
    """A million is restored to coordinates below half a million."""
    return f"({value} + case when {value} < 500000 then 1000000 else 0 end)"


def _nc_panel(size: int, columns: int, first: int) -> Parser:
    cell = f"(n(substr(@1, 7, 2)) - {first})"
    ten = lambda k: f"n(concat(substr(@1, {k}, 1), substr(@1, {k + 2}, 1), substr(@1, {k + 4}, 1))) * 10000"
    return Parser(NC_PANEL, f"{ten(1)} + ({cell} % {columns}) * {size}", f"{ten(2)} + ({columns - 1} - floor({cell} / {columns})) * {size}", f"{cell} >= 0 and {cell} < {columns * columns}")


def _interleaved(first: int) -> str:
    return f"n(concat({', '.join(f'substr(@1, {k}, 1)' for k in range(first, 9, 2))})) * 1000"


_EAST, _NORTH = "instr(upper(@3), 'E') > 0", "instr(upper(@3), 'N') > 0"
_ODD = lambda k: f"(case when #{k} % 10 = 0 then floor(#{k} / 10) else #{k} end)"
_LATTICE = lambda v, origin: f"(ceil(({v} * 100 - {origin}) / 2640.0) * 2640 + {origin})"
_FL_ZONE = "(case upper(@2) when '0901' then 'E' when '0902' then 'W' when '0903' then 'N' else upper(@2) end)"


def _fl(value: str) -> str:
    """Zone by zone: index in the zone, then its row or column."""
    branches = []
    for zone, offset, count, columns, left, top in (("E", 200000, 150000, 300, -330000, 2500000), ("W", 400000, 150000, 300, 0, 2500000), ("N", 600000, 108000, 540, 850000, 970000)):
        index = f"(case when #1 > {offset} then #1 - {offset} when @2 <> '' then #1 else 0 end)"
        found = f"{left} + (({index} - 1) % {columns}) * 5000" if value == "x" else f"{top} - (floor(({index} - 1) / {columns}) + 1) * 5000"
        branches.append(f"when {_FL_ZONE} in ('', '{zone}') and {index} between 1 and {count} then {found}")
    return f"(case {' '.join(branches)} end)"


PARSERS: dict[str, Parser] = {
    "full_xy": Parser(FULL_XY, "#1", "#2"),
    "axis_pair": Parser(AXIS_PAIR, "#2", "#4"),
    "axis_named_pair": Parser(AXIS_PAIR, "case when upper(@3) = 'E' then #4 when upper(@1) = 'E' then #2 when upper(@3) = 'W' then #4 when upper(@1) = 'W' then #2 end", "case when upper(@3) = 'N' then #4 when upper(@1) = 'N' then #2 when upper(@3) = 'S' then #4 when upper(@1) = 'S' then #2 end", "(upper(@1) in ('E', 'W') or upper(@3) in ('E', 'W')) and (upper(@1) in ('N', 'S') or upper(@3) in ('N', 'S'))"),
    "axis_suffix_pair": Parser(AXIS_SUFFIX, "#1", "#2"),
    "number_pair": Parser(NUMBER_PAIR, "#1", "#2"),
    "number_pair_date": Parser(DATED_PAIR, "#1", "#2"),
    "odd_km_pair": Parser(ODD_KM, f"{_ODD(1)} * 1000", f"{_ODD(2)} * 1000", f"{_ODD(1)} % 2 = 1 and {_ODD(2)} % 2 = 1"),
    "ct_quadrant_2500ft": Parser(CT_QUADRANT, f"{_wrap('(#1 * 1000)')} + case when {_EAST} then 2500 else 0 end", f"#2 * 1000 + case when {_NORTH} then 2500 else 0 end"),
    "fl_fdem_5000ft": Parser(FL_INDEX, _fl("x"), _fl("y"), f"{_fl('x')} is not null"),
    "il_mchenry_2500ft": _split(4, _wrap("({x} * 100)"), "{y} * 100 + 2000000"),
    "nh_2500ft": _split(4, _wrap("({x} * 100)"), "{y} * 100"),
    "az_eastern_pima_5k": _split(3, _wrap("({x} * 1000)"), "{y} * 1000"),
    "mt_1000m_wrapped": _split(3, _wrap("({x} * 1000)"), "{y} * 1000"),
    "ca_san_diego_5k": _split(3, "{x} * 1000 + 6000000", "{y} * 1000 + case when {y} < 500 then 2000000 else 1000000 end"),
    "mi_2500ft": _split(3, "r({x} * 1000 / 2500.0) * 2500", "r({y} * 1000 / 2500.0) * 2500", "{x} < 1000 and {y} < 1000"),
    "mi_2500ft_wrapped": _split(3, "r(({x} * 1000 + case when {x} < 500 then 1000000 else 0 end) / 2500.0) * 2500", "r({y} * 1000 / 2500.0) * 2500", "{x} < 1000 and {y} < 1000"),
    "ca_solano_2640ft": Parser(SOLANO, _LATTICE("#1", 400), _LATTICE("#2", 2560)),
    "mn_utm_pair": Parser(MN_PAIR, "#1 * case when length(@1) = 3 then 1000 else 100 end", "#2 * case when length(@1) = 3 then 1000 else 100 end", "length(@1) + 1 = length(@2)"),
    "nj_5000ft": Parser(
        NJ_GRID,
        "190000 + (l(upper(@1)) - 1) * 40000 + case when upper(@3) in ('B', 'D') then 20000 else 0 end + ((#4 - 1) % 4) * 5000",
        "925000 - (#2 - 1) * 40000 - case when upper(@3) in ('C', 'D') then 20000 else 0 end - (floor((#4 - 1) / 4) + 1) * 5000",
        "#2 between 1 and 23 and #4 between 1 and 16",
    ),
    "nc_panel_5000ft": _nc_panel(5000, 2, 1),
    "nc_panel_2500ft": _nc_panel(2500, 4, 5),
    "nc_panel_1250ft": _nc_panel(1250, 8, 21),
    "tn_7000x4000ft": Parser(TN_QUADRANT, f"#1 * 1000 + 503 + case when {_EAST} then 7000 else 0 end", f"#2 * 1000 + 378 + case when {_NORTH} then 4000 else 0 end"),
    "vt_1400m_legacy_center": Parser(
        AXIS_PAIR,
        "#2 * 100",
        "#4 * 100 + case when (#4 * 100 - 700) % 1400 = 0 then 0 when (#4 * 100 + 99300) % 1400 = 0 then 100000 else 200000 end",
        "upper(@1) = 'N' and upper(@3) = 'E' and length(@2) = 4 and length(@4) = 3 and (#2 * 100 - 700) % 1400 = 0 and ((#4 * 100 - 700) % 1400 = 0 or (#4 * 100 + 99300) % 1400 = 0 or (#4 * 100 + 199300) % 1400 = 0)",
    ),
    "zone_full_xy": Parser(ZONE_FULL_XY, "#1", "#2"),
    "pa_luzerne_2500ft": Parser(LUZERNE, "n(substr(@1, 1, length(@1) - 4)) * 100 + case when length(@1) = 8 then 2000000 else 0 end", "n(substr(@1, length(@1) - 3)) * 100"),
    "pa_dauphin_5000ft": Parser(DAUPHIN, "#2 * 1000", "#1 * 100"),
    "letter_row_number_column": Parser(LETTER_ROW, "#2", "case when length(@1) = 1 then l(upper(@1)) else l(upper(substr(@1, 1, 1))) * 26 + l(upper(substr(@1, 2, 1))) end - 1"),
    "sc_5000ft_quadrants": Parser(SC_QUADRANT, "(#1 * 10 + #3) * 10000 + case when #5 in (2, 4) then 5000 else 0 end", "(#2 * 10 + #4) * 10000 + case when #5 in (1, 2) then 5000 else 0 end"),
    "sc_savannah_5000ft": Parser(SC_SAVANNAH, _interleaved(1), _interleaved(2)),
    "sc_savannah_2500ft": Parser(SC_SAVANNAH, f"r({_interleaved(1)} / 2500.0) * 2500", f"r({_interleaved(2)} / 2500.0) * 2500"),
    "wi_sewrpc_10kft": Parser(SEWRPC, "#1 * 1000", "#2 * 1000"),
    "wi_2500ft_quadrants": Parser(
        WI_QUADRANT,
        f"case when @3 = '' then ceil(#1 * 1000 / 2500.0) * 2500 else #1 * 1000 + case when {_EAST} then 2500 else 0 end end",
        f"case when @3 = '' then ceil(#2 * 1000 / 2500.0) * 2500 else #2 * 1000 + case when {_NORTH} then 2500 else 0 end end",
        "@3 = '' or (#1 % 5 = 0 and #2 % 5 = 0)",
    ),
    "wa_thurston_4500ft": Parser(THURSTON, "#1 * case when #1 >= 90000 then 10 else 100 end", "#2 * 10"),
}
for _n in range(3, 8):
    PARSERS[f"single_number_split_{_n}"] = _split(_n)

#: Parsers over MGRS references: (x, y) over the fields of mgrs_sql, then the rewrite of the name that goes before.
_MGRS_RULES: dict[str, tuple[str, str]] = {
    "mgrs": ("easting", "northing"),
    "mgrs_tokens": ("e_token", "n_token"),
    "mgrs_zero_x_next_100km": ("easting + case when e_token = 0 then 100000 else 0 end", "northing"),
    "mgrs_absolute_tokens": ("e_token * resolution * 10", "floor((northing - n_token * resolution) / 1000000) * 1000000 + n_token * resolution * 10"),
}


def _compile(text: str, captures: str, dialect: Dialect) -> str:
    text = re.sub(r"#(\d)", r"n(@\1)", text)
    text = _calls(_calls(_calls(text, "n", f"try_cast({{0}} as {dialect.real})"), "r", dialect.half_even), "l", dialect.letter)
    return re.sub(r"@(\d)", captures, text)


def _calls(text: str, name: str, form: str) -> str:
    """Every call name(...) written as form."""
    out, at = [], 0
    for m in re.finditer(rf"(?<![A-Za-z_]){name}\(", text):
        if m.start() < at:
            continue
        depth, end = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        out += [text[at : m.start()], form.format(_calls(text[m.end() : end - 1], name, form))]
        at = end
    return "".join([*out, text[at:]])


def _quote(pattern: str, dialect: Dialect) -> str:
    return f"r'{pattern}'" if dialect is SPARK else f"'{pattern}'"


def stem_sql(name: str, dialect: Dialect = SPARK) -> str:
    return f"regexp_replace({name}, {_quote(EXTENSION, dialect)}, '')"


def parser_sql(parser: str, name: str, dialect: Dialect = SPARK) -> tuple[str, str]:
    """SQL for x and y of a name that ends in a plain format."""
    p = PARSERS[parser]
    stem, pattern = stem_sql(name, dialect), _quote(p.pattern, dialect)
    hit = f"regexp_extract({stem}, {pattern}, 0) <> ''"
    capture = lambda m: f"regexp_extract({stem}, {pattern}, {m[1]})"
    where = _compile(p.where, capture, dialect)
    form = lambda v: f"cast(case when {hit} then case when {where} then {_compile(v, capture, dialect)} end end as {dialect.real})"
    return form(p.x), form(p.y)


def mgrs_sql(name: str, dialect: Dialect = SPARK, pattern: str = MGRS) -> dict[str, str]:
    """SQL for the parts of the last valid MGRS reference in a name: zone, band, grid and tokens; null without one."""
    quoted = _quote(pattern, dialect)
    lists = ", ".join(f"regexp_extract_all({stem_sql(name, dialect)}, {quoted}, {k})" for k in range(1, 6))
    column = lambda m: " ".join(f"when {m}z % 3 = {(k + 1) % 3} then instr('{letters}', {m}c)" for k, letters in enumerate(COLUMN_SETS))
    if dialect is SPARK:
        zipped = f"transform(arrays_zip({lists}), m -> named_struct('z', cast(m.`0` as int), 'b', upper(m.`1`), 'c', substr(upper(m.`2`), 1, 1), 'w', substr(upper(m.`2`), 2, 1), 'd', m.`3`, 'e', m.`4`))"
        pick = lambda cond: f"try_element_at(filter({zipped}, m -> {cond}), -1)"
    else:
        zipped = f"list_transform(list_zip({lists}), lambda m: {{'z': m[1]::int, 'b': upper(m[2]), 'c': substr(upper(m[3]), 1, 1), 'w': substr(upper(m[3]), 2, 1), 'd': m[4], 'e': coalesce(m[5], '')}})"
        pick = lambda cond: f"list_extract(list_filter({zipped}, lambda m: {cond}), -1)"
    valid = f"m.z between 1 and 60 and coalesce(m.e, '') = '' and length(m.d) % 2 = 0 and length(m.d) between 2 and 10 and instr('{ROW_LETTERS}', m.w) > 0 and (case {column('m.')} end) > 0"
    return {"found": pick(valid), "column": f"(case {column('f.')} end)"}


def mgrs_fields(found: str, column: str, dialect: Dialect = SPARK) -> dict[str, str]:
    """SQL over a struct f, the reference found, for what it means."""
    half = "cast(floor(length(f.d) / 2) as int)"
    e, n = f"try_cast(substr(f.d, 1, {half}) as double)", f"try_cast(substr(f.d, {half} + 1) as double)"
    resolution = f"power(10.0, 5 - {half})"
    base = f"(((instr('{ROW_LETTERS}', f.w) - 1 - case when f.z % 2 = 0 then 5 else 0 end + 20) % 20) * 100000)"
    least = "(case f.b " + " ".join(f"when '{b}' then {v}" for b, v in zip(BANDS, BAND_LEAST, strict=True)) + " end)"
    northing = f"({base} + greatest(0, ceil(({least} - {base}) / 2000000.0)) * 2000000 + {n} * {resolution})"
    south = " ".join(f"'{b}'," for b in BANDS[:10]).rstrip(",")
    return {"e_token": e, "n_token": n, "resolution": resolution, "easting": f"({column} * 100000 + {e} * {resolution})", "northing": northing, "epsg": f"(case when f.b in ({south}) then 32700 else 32600 end + f.z)", "grid": "concat(f.c, f.w)"}


def rewrite(parser: str, name: str, dialect: Dialect = SPARK) -> str:
    """The name as the MGRS rules are to read it: some deliveries have letters or zones that a rule repairs."""
    regexp = lambda text, pattern, to: f"regexp_replace({text}, {_quote(pattern, dialect)}, {_quote(re.sub(r'[$](\d)', r'$\1' if dialect is SPARK else r'\\\1', to), dialect)})"
    if parser in ("mgrs_zone14_legacy_columns", "tx_lower_rio_500m"):
        for old, new in (("Q", "R"), ("P", "Q"), ("O", "P")):  # from the end, so that no letter moves twice
            name = regexp(name, rf"(?i)(14[R-U][_-]?){old}([A-HJ-NP-V][_-]?\d)", f"$1{new}$2")
        return name
    if parser == "mgrs_separated_xy":
        stem, pattern = stem_sql(name, dialect), _quote(MGRS_SEPARATED, dialect)
        return "concat('_', " + ", ".join(f"regexp_extract({stem}, {pattern}, {k})" for k in range(1, 6)) + ", '.laz')"
    if parser == "id_southern_15":
        return regexp(name, r"(?i)11TTM470(965|980)(\.la[sz])$", "11TQG470$1$2")
    if parser == "mgrs_zone_11":  # the last reference in the name, whatever follows it, gets the zone
        stem, pattern = stem_sql(name, dialect), _quote(MGRS, dialect)
        found = f"try_element_at(regexp_extract_all({stem}, {pattern}, 0), -1)" if dialect is SPARK else f"list_extract(regexp_extract_all({stem}, {pattern}, 0), -1)"
        before = f"(length({stem}) - instr(reverse({stem}), reverse({found})) + 1 - length({found}))"
        return f"coalesce(concat(substr({stem}, 1, {before}), '11', " + regexp(f"substr({stem}, {before} + 1)", "^[0-9]{1,2}", "") + f"), {stem})"
    if parser.startswith("mgrs_fixed_"):
        prefix = parser.removeprefix("mgrs_fixed_").upper()
        stem, pattern = stem_sql(name, dialect), _quote(GRID_TOKEN, dialect)
        return f"concat('{prefix}', regexp_extract({stem}, {pattern}, 1), regexp_extract({stem}, {pattern}, 2), '.laz')"
    return name


def mgrs_rule(parser: str) -> tuple[str, str]:
    """x and y over the fields of mgrs_fields."""
    if parser in _MGRS_RULES:
        return _MGRS_RULES[parser]
    if parser.startswith("mgrs_zero_x_columns_"):
        letters = parser.removeprefix("mgrs_zero_x_columns_").upper()
        return f"easting + case when e_token = 0 and instr('{letters}', substr(grid, 1, 1)) > 0 then 100000 else 0 end", "northing"
    if parser == "id_southern_15":
        return "easting + case when e_token = 0 and grid = 'NH' then 100000 else 0 end", "northing"
    return "easting", "northing"


def is_mgrs(parser: str) -> bool:
    return parser.startswith("mgrs") or parser in ("id_southern_15", "tx_lower_rio_500m")


def _fill(text: str, fields: dict[str, str]) -> str:
    return re.sub(r"\b(e_token|n_token|resolution|easting|northing|grid|epsg)\b", lambda m: fields[m[1]], text)


def decode_sql(parser: str, name: str, dialect: Dialect = SPARK) -> tuple[str, str, str, str]:
    """(inner, x, y, epsg): SQL of a struct f to be computed first (or null), then coordinates and code over it."""
    if parser == "zone_tokens" or parser.startswith("zone_tokens_grid_"):
        grid = parser.removeprefix("zone_tokens_grid_").upper() if parser != "zone_tokens" else ""
        found = lambda k: f"regexp_extract_all({stem_sql(name, dialect)}, {_quote(ZONE_TOKENS, dialect)}, {k})"
        own = "length({0}) % 2 = 0 and length({0}) between 2 and 10" + (f" and upper({{1}}) = '{grid}'" if grid else "")
        if dialect is SPARK:
            inner = f"try_element_at(filter(arrays_zip({found(3)}, {found(2)}), m -> {own.format('m.`0`', 'm.`1`')}), -1).`0`"
        else:
            inner = f"list_extract(list_filter(list_zip({found(3)}, {found(2)}), lambda m: {own.format('m[1]', 'm[2]')}), -1)[1]"
        half = "cast(floor(length(f) / 2) as int)"
        return inner, f"try_cast(substr(f, 1, {half}) as double)", f"try_cast(substr(f, {half} + 1) as double)", "cast(null as int)"
    if parser == "ca_eldorado_2500ft":
        inner, x, y, epsg = decode_sql("zone_tokens", name, dialect)
        return inner, f"{x} * 1000 + case when {x} >= 500 then 6000000 else 7000000 end", f"{y} * 1000 + case when {y} >= 500 then 1000000 else 2000000 end", epsg
    if is_mgrs(parser):
        parts = mgrs_sql(rewrite(parser, name, dialect), dialect)
        fields = mgrs_fields("f", parts["column"], dialect)
        x, y = (_fill(v, fields) for v in mgrs_rule(parser))
        if parser == "tx_lower_rio_500m":
            quadrant = f"lower(regexp_extract({name}, {_quote('(?i)_([a-d])[.]la[sz]$', dialect)}, 1))"
            x = f"case when {quadrant} <> '' then {x} + case when {quadrant} in ('b', 'c') then 500 else 0 end end"
            y = f"case when {quadrant} <> '' then {y} + case when {quadrant} in ('a', 'b') then 500 else 0 end end"
        epsg = "cast(null as int)" if parser.startswith("mgrs_fixed_") else fields["epsg"]
        if parser == "tx_lower_rio_500m":
            epsg = f"case when {quadrant} <> '' then {epsg} end"
        return parts["found"], x, y, epsg
    x, y = parser_sql(parser, name, dialect)
    return "null", x, y, "cast(null as int)"


def names_of() -> list[str]:
    """Every parser name without a free part."""
    return sorted({*PARSERS, *_MGRS_RULES, "zone_tokens", "ca_eldorado_2500ft", "mgrs_zone14_legacy_columns", "mgrs_separated_xy", "mgrs_zone_11", "id_southern_15", "tx_lower_rio_500m", "ca_upper_pit_5k"})


@F.pandas_udf(T.StructType().add("x", T.DoubleType()).add("y", T.DoubleType()))
def only_corner(cell: pd.DataFrame) -> pd.DataFrame:
    """The corner of the 5,000-foot state plane grid in a 100 m cell (e, n) of zone 10, null where there is none or more than one.

    The cell's envelope is taken to the state plane, as a rotated point could land on the wrong side of a grid line.
    """
    known = cell["e"].notna().to_numpy() & cell["n"].notna().to_numpy()
    e, n = cell["e"][known].to_numpy(float), cell["n"][known].to_numpy(float)
    low_x, low_y, high_x, high_y = crs.envelopes(e, n, e + 100, n + 100, "EPSG:6339", "EPSG:6416")

    def up(v):
        whole = np.rint(v / 5000)
        return 5000 * np.where(np.abs(v / 5000 - whole) <= 1e-9, whole, np.ceil(v / 5000))

    x, y = up(low_x), up(low_y)
    one = (x <= high_x) & (high_x < x + 5000) & (y <= high_y) & (high_y < y + 5000)
    out = pd.DataFrame({"x": None, "y": None}, index=cell.index, dtype=object)
    out.loc[known, "x"], out.loc[known, "y"] = np.where(one, x, None), np.where(one, y, None)
    return out


def _decode_upper_pit(frame, name: str):
    parts = mgrs_sql(name)
    fields = mgrs_fields("f", parts["column"])
    # bound as a variable, since a column of its own would be computed anew for each mention
    cell = F.expr(f"get(transform(array({parts['found']}), f -> case when f.z = 10 and length(f.d) = 6 then named_struct('e', cast({fields['easting']} as double), 'n', cast({fields['northing']} as double)) end), 0)")
    out = frame.withColumn("_corner", only_corner(cell))
    return out.withColumn("x", F.col("_corner.x")).withColumn("y", F.col("_corner.y")).withColumn("epsg", F.lit(None).cast("int")).drop("_corner")


def decode(frame, parser: str, name: str = "filename"):
    """frame with x, y and epsg of its names by one parser."""
    if parser == "ca_upper_pit_5k":
        return _decode_upper_pit(frame, name)
    inner, x, y, epsg = decode_sql(parser, name)
    shaped = frame.withColumn("f", F.expr(inner)) if inner != "null" else frame
    out = shaped.withColumn("x", F.expr(f"cast({x} as double)")).withColumn("y", F.expr(f"cast({y} as double)")).withColumn("epsg", F.expr(f"cast(case when {'f is not null' if inner != 'null' else 'true'} then {epsg} end as int)"))
    return out.drop("f") if inner != "null" else out


def placeholder(name: Column) -> Column:
    """A stem that ends in an underscore and whose last token is not a number of six digits or more."""
    stem = F.regexp_replace(name, EXTENSION, "")
    return stem.endswith("_") & ~stem.rlike(r"(^|_)[0-9]{6,}_+$")
