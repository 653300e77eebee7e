"""Region tables from boxes and GeoJSON."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import polygons as polygons_module
from geoloom.functions.crs import point_window, system, transform, transform_bounds
from geoloom.functions.text import safe_component

SCHEMA = "region_id string, minx double, miny double, maxx double, maxy double, crs string, ordinal int"
GEOJSON = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"


def named_boxes(spark: SparkSession, source: dict[str, list[float] | dict] | list[float], crs: str, name: str = "region_0") -> DataFrame:
    """One box, or boxes by name, each of which may have its own system. A box needs four finite numbers, low before high."""
    items = {name: source} if isinstance(source, list) else source
    rows = []
    for k, (region, item) in enumerate(items.items()):
        box, own = (item["bounds"], item.get("crs", crs)) if isinstance(item, dict) else (item, crs)
        if len(box) != 4 or not all(map(math.isfinite, box)) or box[0] >= box[2] or box[1] >= box[3]:
            raise ValueError(f"region {region} has no valid bounds: {box}")
        if not region or region in (".", "..") or "/" in region or "\\" in region:
            raise ValueError(f"{region!r} cannot be part of a path")
        rows.append((region, *map(float, box), own, k))
    return spark.createDataFrame(rows, SCHEMA)


KINDS = {"Point": "array<double>", "Polygon": "array<array<array<double>>>", "MultiPolygon": "array<array<array<array<double>>>>"}


def _features(spark: SparkSession, path: str, id_field: str | None) -> DataFrame:
    """(ordinal, region_id, properties, geometry) of a GeoJSON file's features; ids must be there, be fit for a path and be unique."""
    read = spark.read.schema(GEOJSON).json(path, multiLine=True).select(F.posexplode("features").alias("ordinal", "f")).select("ordinal", "f.*")
    named = F.concat(F.lit("feature_"), "ordinal") if id_field is None else F.trim(F.col("properties")[id_field])
    good = F.coalesce(safe_component(named), F.lit(False))
    with_id = read.withColumn("region_id", F.when(good, named).otherwise(F.raise_error(F.format_string(f"feature %d has no usable {id_field}", "ordinal"))))
    twice = F.count(F.lit(1)).over(Window.partitionBy("region_id"))
    checked = with_id.withColumn("_n", twice)
    return checked.withColumn("region_id", F.when(F.col("_n") == 1, F.col("region_id")).otherwise(F.raise_error(F.concat(F.lit("two features are called "), "region_id")))).drop("_n")


def included(rows: DataFrame, values: dict[str, list[str]], properties: str | None = None) -> DataFrame:
    """Rows that have for every field one of its values; both sides are compared as trimmed text. Fields are columns, or keys of a map."""
    for field, accepted in values.items():
        if not field or not accepted:
            raise ValueError("a field to filter by needs a name and values")
        own = F.col(properties)[field] if properties else F.col(field)
        rows = rows.where(F.trim(own.cast("string")).isin(*(str(v).strip() for v in accepted)))
    return rows


def degrees_checked(rows: DataFrame, crs: str, sides: tuple[str, str, str, str] = ("minx", "miny", "maxx", "maxy")) -> DataFrame:
    """Rows whose box could be in degrees, if the system says that it is; else an error as soon as rows are read."""
    if system(crs).method != "geographic":
        return rows
    possible = (F.col(sides[0]) >= -360) & (F.col(sides[2]) <= 360) & (F.col(sides[1]) >= -90) & (F.col(sides[3]) <= 90)
    return rows.where(F.when(possible, True).otherwise(F.raise_error(F.lit(f"places that cannot be degrees, though the system is {crs}"))))


def _valid_rings(polygons: list[list[list[list[float]]]]) -> str | None:
    """What is wrong with a shape's rings, which are closed where they are not: too few places, no area, or an edge that crosses another."""
    for polygon in polygons:
        for ring in polygon:
            points = [tuple(p[:2]) for p in ring]
            points += points[:1] if points and points[0] != points[-1] else []
            if len(points) < 4:
                return "a ring of too few places"
            if polygons_module.signed_area(points[:-1]) == 0:
                return "a ring without area"
            edges = list(zip(points[:-1], points[1:], strict=True))
            for i, (a, b) in enumerate(edges):
                for j in range(i + 2, len(edges)):
                    if (i or j < len(edges) - 1) and _cross(a, b, *edges[j]):
                        return "edges that cross"
    return None if polygons else "no polygon"


def _cross(a, b, c, d) -> bool:
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0


@F.pandas_udf(T.StringType())
def ring_fault(polygons: pd.Series) -> pd.Series:
    return polygons.map(lambda p: "no polygon" if p is None else _valid_rings([[[list(q) for q in ring] for ring in one] for one in p]))


def geojson_polygons(spark: SparkSession, path: str, id_field: str | None, crs: str = "EPSG:4326") -> DataFrame:
    """(region_id, polygons, rings, bounds, crs, ordinal, properties) of polygons and multipolygons; other types, empty and broken shapes
    and impossible degrees are refused when rows are read. rings are those of the first polygon."""
    rows = _features(spark, path, id_field)
    one, many = (F.from_json("geometry.coordinates", KINDS[k]) for k in ("Polygon", "MultiPolygon"))
    kind = F.col("geometry.type")
    shaped = rows.withColumn("polygons", F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many).otherwise(F.raise_error(F.concat(F.lit("no polygon: "), kind))))
    fault = ring_fault("polygons")
    sound = shaped.withColumn("fault", fault).withColumn("polygons", F.when(F.col("fault").isNull(), F.col("polygons")).otherwise(F.raise_error(F.concat(F.col("region_id"), F.lit(" has "), F.col("fault")))))
    points = F.flatten(F.flatten("polygons"))
    side = lambda pick, axis: pick(F.transform(points, lambda p: p[axis]))
    rings = F.transform(F.col("polygons")[0], lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    out = sound.select("region_id", "polygons", rings.alias("rings"), side(F.array_min, 0).alias("minx"), side(F.array_min, 1).alias("miny"), side(F.array_max, 0).alias("maxx"), side(F.array_max, 1).alias("maxy"), F.lit(crs).alias("crs"), "ordinal", "properties")
    return degrees_checked(out, crs)


def geojson_points(spark: SparkSession, path: str, id_field: str | None = None, size_m: float = 500.0, include: dict[str, list[str]] | None = None, crs: str = "EPSG:4326") -> DataFrame:
    """(region_id, x, y, bounds, crs, query_size_m, ordinal, properties): for each point that the filter lets through a square of size_m about it."""
    if not (math.isfinite(size_m) and size_m > 0):
        raise ValueError("a window's size is a positive number")
    rows = included(_features(spark, path, id_field), include or {}, "properties")
    kind, place = F.col("geometry.type"), F.from_json("geometry.coordinates", KINDS["Point"])
    at = F.when((kind == "Point") & (F.size(place) >= 2), place).otherwise(F.raise_error(F.concat(F.col("region_id"), F.lit(" is no point"))))
    return point_regions(rows.select("region_id", at.alias("_p"), "ordinal", "properties").select("region_id", F.col("_p")[0].alias("x"), F.col("_p")[1].alias("y"), "ordinal", "properties"), crs, size_m)


def point_regions(points: DataFrame, crs: str, size_m: float) -> DataFrame:
    """points (x, y and other columns) with the box of a square of size_m metres about each, in their own system."""
    schema = T.StructType([*points.schema.fields, *(T.StructField(s, T.DoubleType()) for s in ("minx", "miny", "maxx", "maxy")), T.StructField("crs", T.StringType()), T.StructField("query_size_m", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [point_window(x, y, crs, size_m) for x, y in zip(frame["x"], frame["y"], strict=True)]
            yield frame.assign(**{s: [b[k] for b in found] for k, s in enumerate(("minx", "miny", "maxx", "maxy"))}, crs=crs, query_size_m=size_m)

    return points.mapInPandas(run, schema)


def reprojected(regions: DataFrame, target: str) -> DataFrame:
    """polygons of regions (region_id, polygons or null, bounds, crs) in another system, corner by corner; a region without a shape is its box's envelope."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if r.polygons is None:
                    x0, y0, x1, y1 = transform_bounds((r.minx, r.miny, r.maxx, r.maxy), r.crs, target)
                    shape = [[[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]]
                else:
                    shape = [[[[float(v) for v in transform(p[0], p[1], r.crs, target)] for p in ring] for ring in one] for one in r.polygons]
                if fault := _valid_rings(shape):
                    raise ValueError(f"region {r.region_id} has {fault} in {target}")
                out.append((r.region_id, shape))
            yield pd.DataFrame(out, columns=["region_id", "polygons"])

    return regions.select("region_id", "polygons", "minx", "miny", "maxx", "maxy", "crs").mapInPandas(run, "region_id string, polygons array<array<array<array<double>>>>")


def batch_envelopes(regions: DataFrame, group: str) -> DataFrame:
    """Per group the box around its regions' boxes."""
    return regions.groupBy(group).agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"), F.count(F.lit(1)).alias("regions"))
