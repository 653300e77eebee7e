"""Assets and what is known of them: kinds and products, selection, and the facts that each source hands on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What assets and results can be.
KINDS = ("file", "image", "raster", "point_cloud")
PRODUCTS = ("generic", "imagery", "dem", "laz", "dsm", "dtm")
STATUSES = ("success", "skipped", "reused", "failed")
#: Facts that a source hands on with each request: the name of the fact, and the column that it comes from.
FACTS: dict[str, dict[str, str]] = {
    "clouds": {"source_crs": "tile_crs", "tile_naming": "naming", "project_rule": "rule", "project": "project", "workunit": "workunit", "collect_end": "collect_end"},
    "catalogue": {"tile_id": "tile_id", "item_url": "item_url", "start_datetime": "start_datetime", "end_datetime": "end_datetime", "checksum": "checksum"},
    "portal": {"sequential": "sequential", "portal_product": "product", "resolution": "resolution", "source_crs": "crs"},
    "sheets": {"sheet_code": "sheet", "source_crs": "crs", "resolution": "resolution"},
    "cells": {"tile": "tile", "resolution": "resolution"},
    "tiles": {"zoom": "zoom", "tile_x": "tile_x", "tile_y": "tile_y"},
}


def product_name(product: Column) -> Column:
    """A product's name, which must be there and have no blank around it; products beyond the known ones are fine."""
    good = product.isNotNull() & (product != "") & (F.trim(product) == product)
    return F.when(good, product).otherwise(F.raise_error(F.concat(F.lit("no product: '"), F.coalesce(product, F.lit("")), F.lit("'"))))


def known(value: Column, values: tuple[str, ...], what: str) -> Column:
    return F.when(value.isin(*values), value).otherwise(F.raise_error(F.concat(F.lit(f"no {what}: "), F.coalesce(value, F.lit("null")))))


def selected(assets: DataFrame, products: list[str] | None = None, kind: str = "raster") -> DataFrame:
    """Assets of a kind and, where products are named, of one of them."""
    rows = assets.where(F.col("kind") == kind)
    return rows if products is None else rows.where(F.col("product").isin(*products))


def with_facts(rows: DataFrame, source: str) -> DataFrame:
    """Rows with metadata, a map of the facts that a source hands on; columns that are not there, and nulls, are left out."""
    pairs = [(fact, column) for fact, column in FACTS[source].items() if column in rows.columns]
    entries = F.filter(F.array(*(F.struct(F.lit(fact).alias("key"), F.col(column).cast("string").alias("value")) for fact, column in pairs)), lambda e: e["value"].isNotNull())
    return rows.withColumn("metadata", F.map_from_entries(entries))


def target_grid(regions: DataFrame) -> DataFrame:
    """(region_id, has_target, has_point, has_shape): what a region carries besides its box; a column that is not there counts as none."""
    there = lambda *names: F.lit(True) if all(n in regions.columns for n in names) else F.lit(False)
    full = lambda *names: (there(*names) & [F.col(n).isNotNull() for n in names if n in regions.columns][0]) if any(n in regions.columns for n in names) else F.lit(False)
    return regions.select("region_id", full("target_path", "width", "height").alias("has_target"), full("x", "y").alias("has_point"), full("polygons").alias("has_shape"))


def late_regions(report: DataFrame, published: DataFrame) -> DataFrame:
    """Regions of a source's final report (region_id, status) that have assets and no failure and were not published on the way: what a
    source that only reports at its end leaves to be processed."""
    sums = report.groupBy("region_id").agg(F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") != "failed").alias("assets"))
    return sums.where("failed = 0 and assets > 0").join(published.select("region_id").distinct(), "region_id", "left_anti").select("region_id", "assets")
