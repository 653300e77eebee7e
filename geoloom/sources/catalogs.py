"""Published catalogues as tables: static STAC collections, sheet quadrangles, product searches, release lists, audits.

Each function takes a frame with one document as text a row, as spark.read.text(wholetext=True) or a download gives it.
"""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions.grids import sheet_code
from geoloom.operators.planning import delivery_version

LINKS = "struct<links:array<struct<rel:string,href:string>>>"
ASSET = "struct<href:string,type:string,`file:checksum`:string>"
ITEM = f"struct<id:string,bbox:array<double>,geometry:struct<type:string,coordinates:string>,assets:map<string,{ASSET}>,properties:struct<datetime:string,start_datetime:string,end_datetime:string>>"
QUADRANGLES = "struct<type:string,features:array<struct<properties:struct<id_quad:string,name:string,color:string>,geometry:struct<coordinates:array<array<array<double>>>>>>>"
PRODUCTS = "struct<value:array<struct<Id:string,Attributes:array<struct<Name:string,Value:string>>>>>"
AUDIT = "array<struct<workunit:string,project:string,lpc_link:string,collect_end:string,horiz_crs:string,targets:array<struct<region_id:string,bounds:array<double>,crs:string,target_path:string>>>>"
# Fixed value: colours of the sheets that can be had.
AVAILABLE = ("green", "#9acd32")


@F.pandas_udf(T.StringType())
def absolute(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link as seen from the document that holds it."""
    return pd.Series([None if x is None else urljoin(b or "", x) for b, x in zip(base, link, strict=True)], dtype=object)


def _required(value: Column, what: str, good: Column | None = None) -> Column:
    return F.when(value.isNotNull() if good is None else good, value).otherwise(F.raise_error(F.lit(what)))


def stac_item_links(collections: DataFrame, url: str = "url", document: str = "document") -> DataFrame:
    """(collection_url, item_url) of item links, each once."""
    links = F.from_json(document, LINKS)["links"]
    found = collections.select(F.col(url).alias("collection_url"), F.explode(_required(links, "a collection has no list of links")).alias("l")).where("l.rel = 'item' AND l.href <> ''")
    return found.select("collection_url", absolute("collection_url", "l.href").alias("item_url")).distinct()


def _is_tiff(asset: Column) -> Column:
    named = F.lower(F.regexp_extract(F.regexp_replace(asset["href"], "[?#].*", ""), r"(\.[^./]*)$", 1)).isin(".tif", ".tiff")
    return F.coalesce((asset["href"] != "") & (F.lower(F.coalesce(asset["type"], F.lit(""))).contains("tiff") | named), F.lit(False))


def stac_items(items: DataFrame, url: str = "item_url", document: str = "document") -> DataFrame:
    """(tile_id, bounds, geometry, url, item_url, start and end, checksum): the asset named visual if it is a TIFF, else the first that is."""
    read = items.select(F.col(url).alias("item_url"), F.from_json(document, ITEM).alias("i"))
    visual = F.col("i.assets")["visual"]
    first = F.get(F.filter(F.map_values("i.assets"), _is_tiff), F.lit(0))
    chosen = read.withColumn("a", F.when(_is_tiff(visual), visual).otherwise(first))
    props = F.col("i.properties")
    return chosen.select(
        _required(F.trim("i.id"), "an item has no id", F.trim("i.id") != "").alias("tile_id"),
        *(_required(F.col("i.bbox"), "an item has no box", F.size("i.bbox") >= 4)[k].alias(side) for k, side in enumerate(("minx", "miny", "maxx", "maxy"))),
        _required(F.col("i.geometry"), "an item has no geometry").alias("geometry"),
        absolute("item_url", _required(F.col("a.href"), "an item has no GeoTIFF asset")).alias("url"),
        "item_url",
        F.coalesce(props["start_datetime"], props["datetime"]).alias("start_datetime"),
        F.coalesce(props["end_datetime"], props["datetime"]).alias("end_datetime"),
        F.col("a.`file:checksum`").alias("checksum"),
    )


def quadrangles(documents: DataFrame, document: str = "document") -> DataFrame:
    """(sheet, portal_id, municipality, color, bounds) of the sheets that can be had; of equal sheets the first.

    A sheet is named by the centre of its box. One that two features give different portal ids is an error.
    """
    read = documents.select(F.from_json(document, QUADRANGLES).alias("d"))
    kept = read.select(F.posexplode(_required(F.col("d.features"), "no feature collection", F.col("d.type") == "FeatureCollection")).alias("ordinal", "f")).where(F.lower("f.properties.color").isin(*AVAILABLE))
    ring = F.col("f.geometry.coordinates")[0]
    whole = (F.trim("f.properties.id_quad") != "") & (F.trim("f.properties.name") != "") & (F.size(ring) >= 4)
    side = lambda pick, k: pick(F.transform(_required(ring, "a quadrangle lacks its name or shape", F.coalesce(whole, F.lit(False))), lambda p: p[k]))
    boxed = kept.select("ordinal", F.trim("f.properties.id_quad").alias("portal_id"), F.trim("f.properties.name").alias("municipality"), F.lower("f.properties.color").alias("color"), side(F.array_min, 0).alias("minx"), side(F.array_min, 1).alias("miny"), side(F.array_max, 0).alias("maxx"), side(F.array_max, 1).alias("maxy"))
    coded = boxed.withColumn("sheet", sheet_code((F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2))
    rest = ["portal_id", "municipality", "color", "minx", "miny", "maxx", "maxy"]
    first = coded.groupBy("sheet").agg(F.min_by(F.struct(*rest), "ordinal").alias("q"), F.min("portal_id").alias("a"), F.max("portal_id").alias("b"))
    return first.select(F.when(F.col("a") == F.col("b"), F.col("sheet")).otherwise(F.raise_error(F.concat(F.lit("portal ids conflict on sheet "), "sheet"))).alias("sheet"), "q.*")


def latest_products(searches: DataFrame, key: str, document: str = "document") -> DataFrame:
    """(key, product_id): the latest delivery of each search's products; ties go to the smaller id, unreadable versions last."""
    product = searches.select(key, F.explode(F.from_json(document, PRODUCTS)["value"]).alias("p")).where("p.Id <> ''")
    version = F.get(F.filter("p.Attributes", lambda a: a["Name"] == "dataset"), F.lit(0))["Value"]
    year, delivery = delivery_version(F.coalesce(version, F.lit("")))
    rank = F.struct(-F.coalesce(year, F.lit(-1)), -F.coalesce(delivery, F.lit(-1)), F.col("p.Id"))
    return product.groupBy(key).agg(F.min_by("p.Id", rank).alias("product_id"))


def releases(documents: DataFrame, document: str = "document", title: str = "itemTitle") -> DataFrame:
    """(version, date) of a map from version to entry whose title holds an ISO date; others are left out."""
    read = documents.select(F.explode(F.from_json(document, f"map<string,struct<{title}:string>>")).alias("version", "entry"))
    return read.select("version", F.expr(f"try_to_date(regexp_extract(entry.{title}, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), 'yyyy-MM-dd')").alias("date")).where("date IS NOT NULL")


def audits(documents: DataFrame, states: list[str] | None = None, document: str = "document") -> DataFrame:
    """Work units of audit reports, each (lpc_link, workunit) once with all its targets by region; of repeated regions the last.

    states keeps targets whose region id starts with one of them and two underscores; units without a target go.
    """
    item = documents.select(F.monotonically_increasing_id().alias("file"), F.from_json(document, AUDIT).alias("a")).select("file", F.posexplode("a").alias("ordinal", "w"))
    target = item.select("file", "ordinal", "w.*", F.posexplode("w.targets").alias("place", "target")).drop("targets")
    if states:
        target = target.where(F.split("target.region_id", "__")[0].isin(*states))
    order = F.struct("file", "ordinal", "place")
    own = target.groupBy("lpc_link", "workunit", "target.region_id").agg(F.max_by("target", order).alias("target"), F.min_by(F.struct("project", "collect_end", "horiz_crs"), order).alias("w"), F.min(order).alias("o"))
    return own.groupBy("lpc_link", "workunit").agg(F.min_by("w", "o").alias("w"), F.array_sort(F.collect_list("target")).alias("targets")).select("lpc_link", "workunit", "w.*", "targets")


def fresh_or_stale(fresh: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """Fresh rows, and cached ones of keys that the refresh did not bring; stale says which."""
    old = cached.join(fresh.select(key).distinct(), key, "left_anti")
    return fresh.withColumn("stale", F.lit(False)).unionByName(old.withColumn("stale", F.lit(True)))
