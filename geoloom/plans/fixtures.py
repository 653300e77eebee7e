"""Geodata derived from the star-schema tables, as SQL that Spark and the oracle's engine both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (table, column: expression, condition)
FIXTURES: dict[str, tuple[str, dict[str, str], str]] = {
    "points": ("lineitem", {"file_id": "l_suppkey", "x": "((l_orderkey * 37 + l_linenumber * 11) % 5000) / 10e0", "y": "((l_partkey * 53 + l_linenumber * 7) % 5000) / 10e0", "z": "l_extendedprice", "classification": "cast(l_quantity as int) % 20"}, "true"),
    "regions": ("customer", {"region_id": "c_custkey", "minx": "cast((c_custkey * 7919) % 1000 as double)", "miny": "cast((c_custkey * 104729) % 1000 as double)", "maxx": "cast((c_custkey * 7919) % 1000 + 5 + c_nationkey as double)", "maxy": "cast((c_custkey * 104729) % 1000 + 8 + c_nationkey as double)", "state": "c_mktsegment"}, "true"),
    "tiles": ("part", {"tile_id": "p_partkey", "minx": "cast((p_partkey * 613) % 1000 as double)", "miny": "cast((p_partkey * 89) % 1000 as double)", "maxx": "cast((p_partkey * 613) % 1000 + 40 + p_size % 7 as double)", "maxy": "cast((p_partkey * 89) % 1000 + 40 + p_size % 5 as double)", "rank": "cast(p_partkey % 17 as int)"}, "true"),
    "places": ("customer", {"region_id": "c_custkey", "minx": "((c_custkey * 7919) % 3000) / 10e0 - 150.05e0", "miny": "((c_custkey * 104729) % 1200) / 10e0 - 60.05e0", "maxx": "((c_custkey * 7919) % 3000) / 10e0 - 150.05e0 + (1 + c_nationkey) / 20e0", "maxy": "((c_custkey * 104729) % 1200) / 10e0 - 60.05e0 + (1 + c_nationkey) / 25e0"}, "true"),
    "south": ("customer", {"region_id": "c_custkey", "minx": "((c_custkey * 7919) % 3000) / 100e0 - 65.013e0", "miny": "-((c_custkey * 104729) % 2000) / 100e0 - 10.017e0", "maxx": "((c_custkey * 7919) % 3000) / 100e0 - 65.013e0 + (1 + c_nationkey) / 300e0", "maxy": "-((c_custkey * 104729) % 2000) / 100e0 - 10.017e0 + (1 + c_nationkey) / 400e0"}, "true"),
    "requests": ("lineitem", {"region_id": "concat('r', cast(l_suppkey as string))", "filename": "concat('f', cast(l_partkey as string), '.laz')", "ordinal": "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 1000 + cast(l_quantity as int) * 10 + l_suppkey % 10", "status": "case when l_partkey % 23 = 0 then 'failed' when l_partkey % 7 = 0 then 'skipped' else 'success' end", "closed": "l_suppkey % 9 <> 0", "arrived": "l_partkey % 31 <> 0"}, "true"),
    "cells": ("lineitem", {"raster_id": "cast(l_suppkey % 3 as int)", "row": "cast(l_orderkey % 48 as int)", "col": "cast(l_partkey % 40 as int)", "value": "case when l_linenumber % 5 = 0 then null else cast(floor(l_extendedprice) as double) end", "ordinal": "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 1000 + cast(l_quantity as int) * 10 + l_suppkey % 10"}, "true"),
    "runs": ("events", {"pipeline": "cast(user_id % 50 as int)", "us": "{micros}", "seq": "event_id", "event": "event_type", "worker": "user_id", "amount": "value"}, "true"),
    "names": ("part", {"k": "p_partkey", "a": "cast(1000 + (p_partkey * 7) % 9000 as string)", "b": "cast(1000 + (p_partkey * 13) % 9000 as string)", "c": "cast(100 + (p_partkey * 3) % 900 as string)", "d": "cast(100 + (p_partkey * 17) % 900 as string)", "q": "case p_partkey % 4 when 0 then 'NE' when 1 then 'NW' when 2 then 'SE' else 'SW' end"}, "true"),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns, where = FIXTURES[name]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").where(where)
    return rows.selectExpr(*(f"{e.replace('{micros}', 'unix_micros(cast(ts as timestamp))')} AS {c}" for c, e in columns.items()))


def fixture_sql(name: str) -> str:
    """The same rows for the oracle."""
    table, columns, where = FIXTURES[name]
    items = ", ".join(f"{e.replace('{micros}', 'epoch_us(ts)')} AS {c}" for c, e in columns.items()).replace(" as string)", " as varchar)")
    return f"(SELECT {items} FROM {table} WHERE {where})"
