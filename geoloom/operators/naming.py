"""A catalogue of naming rules, and tiles planned by it: a file's unit picks a rule, the rule's first fitting scheme its box."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions import filenames, grids
from geoloom.operators.planning import match_rules

UNIT = ("workunit", "project", "lpc_link")
ANCHORS = ("min", "max", "center")
#: Parts of a grid model on each axis: the name in a catalogue and the one projected_box reads.
AXIS = {"scale": "{}_scale", "offset": "{}_offset", "origin": "{}_grid_origin", "ceil": "{}_ceil_step", "floor": "{}_floor_step", "round": "{}_round_step", "padding": "{}_padding"}
SCHEME = "parser string, crs string, naming string, " + ", ".join(f"{axis}_anchor string, {axis}_size double, " + ", ".join(f"{axis}_{n} double" for n in AXIS) for axis in "xy")
#: Codes up to this one belong to EPSG, longer ones to ESRI.
LAST_EPSG = 32767
PROJECTED = "ca_upper_pit_5k"
#: Unread names that an audit shows of a unit.
EXAMPLES = 10


@dataclass(frozen=True)
class Rule:
    name: str
    match: dict[str, str]
    schemes: list[dict]


def _known(parser: object) -> bool:
    free = r"single_number_split_[3-7]|mgrs_zero_x_columns_[a-hj-np-z]+|zone_tokens_grid_[a-z]{2}|mgrs_fixed_\d{1,2}[c-x]"
    return isinstance(parser, str) and (parser in filenames.names_of() or re.fullmatch(free, parser) is not None)


def _scheme(rule: str, raw: dict) -> dict:
    parser, grid = raw.get("parser"), raw.get("grid")
    if not _known(parser):
        raise ValueError(f"rule {rule}: unknown parser {parser!r}")
    needed = [f"{axis}_{n}" for axis in "xy" for n in ("scale", "offset", "anchor")] + ["width", "height"]
    if not isinstance(grid, dict) or (lacking := [n for n in needed if n not in grid]):
        raise ValueError(f"rule {rule}: the grid of {parser} lacks {lacking if isinstance(grid, dict) else 'everything'}")
    out = {"parser": parser, "crs": str(raw.get("crs", "workunit")), "naming": None if raw.get("naming") is None else str(raw["naming"])}
    for axis, size in (("x", "width"), ("y", "height")):
        out |= {f"{axis}_{n}": float(grid.get(key.format(axis), 0.0)) for n, key in AXIS.items()}
        out |= {f"{axis}_anchor": grid[f"{axis}_anchor"], f"{axis}_size": float(grid[size])}
        steps = [out[f"{axis}_{n}"] for n in ("ceil", "floor", "round")]
        if out[f"{axis}_anchor"] not in ANCHORS or out[f"{axis}_size"] <= 0 or min(steps) < 0 or sum(s > 0 for s in steps) > 1:
            raise ValueError(f"rule {rule}: the {axis} axis of {parser} has a wrong anchor, size or rounding")
    return out


def parse_rules(raw: dict) -> list[Rule]:
    """The rules of a catalogue of version 1; what does not fit is refused by name."""
    if not isinstance(raw, dict) or raw.get("version") != 1 or not isinstance(raw.get("projects"), list):
        raise ValueError("a rule catalogue needs version 1 and a list of projects")
    rules = []
    for item in raw["projects"]:
        name, match, schemes = (item.get(k) for k in ("name", "match", "schemes"))
        if not isinstance(name, str) or not name:
            raise ValueError("a rule needs a name")
        if not isinstance(match, dict) or not match or set(match) - set(UNIT) or not all(isinstance(v, str) and v for v in match.values()):
            raise ValueError(f"rule {name} needs patterns for some of {UNIT} and nothing else")
        if not isinstance(schemes, list) or not schemes:
            raise ValueError(f"rule {name} needs schemes")
        for pattern in match.values():
            re.compile(pattern)
        rules.append(Rule(name, dict(match), [_scheme(name, s) for s in schemes]))
    return rules


def read_rules(path: str) -> list[Rule]:
    import yaml

    with open(path, encoding="utf-8") as f:
        return parse_rules(yaml.safe_load(f) or {})


def _decoded(parser: str, projected: str) -> str:
    """SQL of a struct (x, y, epsg) of the column filename."""
    if parser == PROJECTED:
        return f"named_struct('x', {projected}.x, 'y', {projected}.y, 'epsg', cast(null as int))"
    inner, x, y, epsg = filenames.decode_sql(parser, "filename")
    found = f"named_struct('x', cast({x} as double), 'y', cast({y} as double), 'epsg', cast({epsg} as int))"
    return found if inner == "null" else f"get(transform(array({inner}), f -> {found}), 0)"


def plan_tiles(files: DataFrame, rules: list[Rule]) -> DataFrame:
    """files with rule, naming, minx to maxy and tile_crs by the first scheme that reads the name and has a system.

    files: (workunit, project, lpc_link, horiz_crs, filename) and other columns, which stay. A unit that two rules fit is
    an error; without a rule, and for names that no scheme reads, the new columns are null. no_system marks names that
    were read by a scheme without a system. Rules meet units, not files, and schemes are tried within the row, so the
    only shuffle is that of the units.
    """
    spark = files.sparkSession
    units = match_rules(files.select(*UNIT).distinct(), [(r.name, r.match) for r in rules])
    one = F.when(F.col("ambiguous"), F.raise_error(F.concat(F.lit("several rules fit a unit: "), F.array_join("rules", ", ")))).otherwise(F.get("rules", F.lit(0)))
    schemes = spark.createDataFrame([(r.name, [tuple(s[f.split()[0]] for f in SCHEME.split(", ")) for s in r.schemes]) for r in rules], f"rule string, schemes array<struct<{', '.join(':'.join(f.split()) for f in SCHEME.split(', '))}>>")
    ruled = units.select(*(F.col(c).alias(f"_u_{c}") for c in UNIT), one.alias("rule")).join(F.broadcast(schemes), "rule", "left")  # a row per rule of the catalogue
    same = [F.col(c).eqNullSafe(F.col(f"_u_{c}")) for c in UNIT]
    rows = files.join(ruled, same[0] & same[1] & same[2], "left").drop(*(f"_u_{c}" for c in UNIT))
    empty = F.lit(None).cast("struct<x:double,y:double>")
    if any(s["parser"] == PROJECTED for r in rules for s in r.schemes):
        uses = F.coalesce(F.exists("schemes", lambda s: s["parser"] == PROJECTED), F.lit(False))
        own = [*rows.columns]
        read = filenames.decode(rows.where(uses).select(F.struct(*own).alias("_row"), "filename"), PROJECTED).select("_row.*", F.struct("x", "y").alias("_projected"))
        rows = rows.where(~uses).withColumn("_projected", empty).unionByName(read)
    else:
        rows = rows.withColumn("_projected", empty)
    parsers = sorted({s["parser"] for r in rules for s in r.schemes})
    read = "case s.parser " + " ".join(f"when '{p}' then {_decoded(p, '_projected')}" for p in parsers) + " end"
    code = f"case when try_cast(horiz_crs as int) <= {LAST_EPSG} then concat('EPSG:', horiz_crs) when try_cast(horiz_crs as int) is not null then concat('ESRI:', horiz_crs) end"
    system = f"case s.crs when 'mgrs' then concat('EPSG:', cast(p.epsg as string)) when 'workunit' then {code} else s.crs end"
    tried = f"filter(flatten(transform(schemes, s -> transform(array({read}), p -> named_struct('s', s, 'x', p.x, 'y', p.y, 'tile_crs', {system})))), t -> t.x is not null and t.y is not null)"
    # a generator of one row keeps what it made as a column: projections above would else copy the whole expression for each mention
    once = lambda frame, made, name: frame.select("*", F.explode(F.array(made)).alias(name))
    first = once(once(rows, F.expr(tried), "_tried"), F.expr("get(filter(_tried, t -> t.tile_crs is not null), 0)"), "_t")
    kept = [*files.columns, "rule"]
    flat = first.select(F.struct(*kept).alias("_row"), F.coalesce(F.size("_tried") > 0, F.lit(False)).alias("_read"), "_t.x", "_t.y", "_t.tile_crs", "_t.s.*")
    (x0, x1), (y0, y1) = grids.projected_box("x"), grids.projected_box("y")
    naming = F.when(F.col("x").isNotNull(), F.coalesce("naming", "parser"))
    box = F.struct(naming.alias("naming"), x0.alias("minx"), y0.alias("miny"), x1.alias("maxx"), y1.alias("maxy"), F.col("tile_crs"), (F.col("_read") & F.col("x").isNull()).alias("no_system"))
    return flat.select("_row", F.explode(F.array(box)).alias("_box")).select("_row.*", "_box.*")


def audit(planned: DataFrame) -> DataFrame:
    """Per unit, from plan_tiles' rows: files, tiles, unread names, the first ten of these by name, and matched, partial or unmatched."""
    # names are folded first, as a filter on the planned columns would be pushed into the scan with all that they stand for
    folded = planned.groupBy(F.struct(*UNIT).alias("unit"), "rule", "filename").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("minx").isNotNull()).alias("read"), F.max("no_system").alias("no_system"))
    names = folded.withColumn("placeholder", F.coalesce(filenames.placeholder(F.col("filename")), F.lit(False)))
    lost = ~F.col("placeholder") & ~F.col("read")
    total = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    counted = names.groupBy("unit", "rule").agg(total(~F.col("placeholder")).alias("files"), total(F.col("read") & ~F.col("placeholder")).alias("tiles"), total(lost).alias("unread"), total(F.col("placeholder")).alias("placeholders"), total(F.col("no_system")).alias("without_system"))
    ranked = names.where(lost).withColumn("_n", F.row_number().over(Window.partitionBy("unit").orderBy("filename")))
    shown = ranked.where(F.col("_n") <= EXAMPLES).groupBy(F.col("unit").alias("_unit")).agg(F.array_sort(F.collect_list("filename")).alias("examples"))
    status = F.when(F.col("tiles") == 0, "unmatched").when(F.col("unread") > 0, "partial").otherwise("matched")
    return counted.join(shown, F.col("unit").eqNullSafe(F.col("_unit")), "left").select("unit.*", "rule", "files", "tiles", "unread", "placeholders", "without_system", F.coalesce("examples", F.array().cast("array<string>")).alias("examples"), status.alias("status"))
