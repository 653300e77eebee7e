"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import checkpoint


def _large(edges: DataFrame) -> DataFrame:
    """Each node hands the least of its neighbours and itself to its larger neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node hands the least of its smaller neighbours to the others and to itself. Here a > b in all edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for each node of an edge (a, b), the least node that it reaches."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = checkpoint(edges)
    state = None
    while True:
        edges = checkpoint(_small(_large(edges)).where("a > b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.groupBy("a").agg(F.min("b").alias("label"))
    return stars.select(F.col("a").alias("node"), "label").union(stars.select(F.col("label").alias("node"), "label").distinct())
