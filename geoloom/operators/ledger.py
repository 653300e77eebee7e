"""Which regions are ready: files fan out to regions, a region is published when its plan is closed and all its files are there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fan_out(files: DataFrame) -> DataFrame:
    """A row for each region that needs a file; for all but the owner a success is a reuse. files: (filename, region_id, target_region_ids, status)."""
    rows = files.withColumn("target", F.explode(F.array_union(F.array("region_id"), "target_region_ids")))
    status = F.when((F.col("target") == F.col("region_id")) | (F.col("status") != "success"), F.col("status")).otherwise("reused")
    return rows.select("filename", F.col("target").alias("region_id"), status.alias("status"))


def readiness(needs: DataFrame, closed: DataFrame) -> DataFrame:
    """Per region: counts, and ready, failed, empty, pending or open. needs: (region_id, filename, status or null); closed: (region_id)."""
    done = F.col("status").isin("success", "reused", "skipped")
    counts = needs.groupBy("region_id").agg(F.count_if(done).alias("assets"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status").isNull()).alias("pending"))
    joined = closed.select("region_id", F.lit(True).alias("closed")).distinct().join(counts, "region_id", "full_outer")
    filled = joined.select("region_id", F.coalesce("closed", F.lit(False)).alias("closed"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("assets", "failed", "pending")))
    state = F.when(F.col("failed") > 0, "failed").when(~F.col("closed"), "open").when(F.col("pending") > 0, "pending").when(F.col("assets") == 0, "empty").otherwise("ready")
    return filled.withColumn("state", state)


def status_counts(rows: DataFrame, group: str) -> DataFrame:
    return rows.groupBy(group).agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("success", "skipped", "reused", "failed")), F.count("*").alias("total"))


def missing_outputs(planned: DataFrame, produced: DataFrame, key: list[str]) -> DataFrame:
    return planned.join(produced.select(*key).distinct(), key, "left_anti")


def complete_groups(required: DataFrame, existing: DataFrame, group: str, item: str) -> DataFrame:
    """Groups all of whose items exist."""
    found = required.join(existing.select(item).distinct().withColumn("_there", F.lit(1)), item, "left")
    return found.groupBy(group).agg(F.count("*").alias("required"), F.count("_there").alias("there")).where("required = there")


def with_history(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Current rows with the previous state and whether the input changed. Both have (key, state, fingerprint)."""
    old = previous.select(F.col(key), F.col("state").alias("previous_state"), F.col("fingerprint").alias("_f"))
    out = current.join(old, key, "left")
    return out.withColumn("changed", F.coalesce(F.col("_f") != F.col("fingerprint"), F.lit(False))).drop("_f")


def latest_state(events: DataFrame, key: str) -> DataFrame:
    return events.groupBy(key).agg(F.max_by("event", F.struct("ts", "seq")).alias("state"), F.count("*").alias("events"))


def utilisation(events: DataFrame, group: str) -> DataFrame:
    """Time-weighted mean of active workers while any is active, and the busy seconds. events: (group, us, seq, delta)."""
    w = Window.partitionBy(group).orderBy("us", "seq")
    active = F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0))
    steps = events.withColumn("active", active).withColumn("span", (F.lead("us").over(w) - F.col("us")).cast("double") / 1e6)
    busy = F.sum(F.when(F.col("active") > 0, F.col("span")).otherwise(0.0))
    out = steps.groupBy(group).agg(F.sum(F.when(F.col("active") > 0, F.col("active") * F.col("span")).otherwise(0.0)).alias("_work"), busy.alias("busy_seconds"))
    return out.select(group, F.round("busy_seconds", 3).alias("busy_seconds"), F.round(F.try_divide("_work", "busy_seconds"), 3).alias("average_active"))


def milestones(events: DataFrame, group: str, total: Column, steps: int = 10) -> DataFrame:
    """Events at which a further tenth of a group's total is done. events: (group, seq)."""
    w = Window.partitionBy(group).orderBy("seq")
    done = events.withColumn("total", total).withColumn("done", F.row_number().over(w))
    marked = done.withColumn("step", F.floor(F.col("done") * steps / F.col("total")))
    marked = marked.withColumn("before", F.coalesce(F.lag("step").over(w), F.lit(0)))
    return marked.where("step > before").select(group, "seq", "done", "step")


def rate(done: Column, total: Column, seconds: Column) -> tuple[Column, Column]:
    """Files a second and the seconds left; null when nothing is done yet."""
    speed = F.try_divide(done.cast("double"), F.nullif(seconds, F.lit(0.0)))
    return speed, F.try_divide((total - done).cast("double"), F.nullif(speed, F.lit(0.0)))


def duration(seconds: Column) -> Column:
    """1d 02h 03m 04s, leaving out leading parts that are zero; unknown for null."""
    s = F.floor(seconds)
    d, h, m, r = F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60), s % 60
    two = lambda v, unit: F.concat(F.lpad(v.cast("string"), 2, "0"), F.lit(unit))
    text = F.concat_ws(" ", F.when(d > 0, F.concat(d.cast("string"), F.lit("d"))), F.when((d > 0) | (h > 0), two(h, "h")), F.when((d > 0) | (h > 0) | (m > 0), two(m, "m")), two(r, "s"))
    return F.when(seconds.isNull(), "unknown").otherwise(text)
