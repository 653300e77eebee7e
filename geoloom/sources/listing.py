"""Folders of rasters as tables, from listings alone: no file is opened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.text import basename


def folder(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, stem, extension, bytes) of the files right in a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path).select("path", F.col("length").alias("bytes"))
    named = files.withColumn("name", basename(F.col("path")))
    return named.select("path", "name", F.regexp_replace("name", r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1)).alias("extension"), "bytes")


def _ends_in(stem: Column, suffixes: list[str]) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | F.lower(stem).endswith("_" + s.lower().lstrip("_"))
    return out


def target_rasters(files: DataFrame, skip_suffixes: list[str] | None = None) -> DataFrame:
    """Rasters to work on: TIFF names that end in none of the suffixes. Output of an earlier run is thus no input."""
    return files.where(F.col("extension").isin(".tif", ".tiff") & ~_ends_in(F.col("stem"), skip_suffixes or []))


def without_outputs(files: DataFrame, suffixes: list[str]) -> DataFrame:
    """Target rasters of which a sibling for some suffix is missing."""
    targets = target_rasters(files, suffixes)
    wanted = targets.select(F.col("stem").alias("of"), F.explode(F.array(*(F.concat("stem", F.lit("_" + s.lstrip("_"))) for s in suffixes))).alias("stem"))
    there = files.where(F.col("extension").isin(".tif", ".tiff")).select("stem").distinct()
    lacking = wanted.join(there, "stem", "left_anti").select(F.col("of").alias("stem")).distinct()
    return targets.join(lacking, "stem", "left_semi")


def pairs(files: DataFrame, suffix: str = "lidar") -> DataFrame:
    """(stem, base, upper): each raster that has a sibling with the suffix, and that sibling."""
    tiffs = files.where(F.col("extension") == ".tif").select("stem", "path")
    ending = "_" + suffix
    upper = tiffs.where(F.col("stem").endswith(ending)).select(F.expr(f"left(stem, length(stem) - {len(ending)})").alias("stem"), F.col("path").alias("upper"))
    return tiffs.withColumnRenamed("path", "base").join(upper, "stem")
