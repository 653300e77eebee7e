"""The state of a run as views of an append-only log, and its checkpoints as JSON.

The log has a row per event: (pipeline, seq, ts, kind, region_id, key, status, text, amount), seq ordering the events of a pipeline.

    pipeline   a run of a pipeline starts; amount is the number of its workers
    region     a target is registered; status existing or pending, text its input, key the output that is expected
    request    a file (key) is wanted for a region; text is its address
    duplicate  a second request for a file that was asked for
    issue      planning met a problem; status and text tell which
    planned    the plan is closed
    started    a worker begins a file
    transfer   a file came; status success, existing, skipped or failed, amount its bytes
    finished   a worker ends a file; text is the error, if any
    ready, building, built   a target waits, is being built, is done; text is the error, key an output that was produced
    closed     the pipeline ends; targets that never were ready are settled then
    failed, interrupted, complete   the run as a whole
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENTS = "pipeline string, seq long, ts double, kind string, region_id string, key string, status string, text string, amount double"
VERSION = 1
FINAL = ("complete", "existing", "failed", "unavailable")
#: Kinds after which the state is saved at once.
URGENT = ("pipeline", "issue", "planned", "closed", "failed", "interrupted", "complete")


def _of(*kinds: str) -> Column:
    return F.col("kind").isin(*kinds)


def file_states(events: DataFrame) -> DataFrame:
    """Per file: planned, running, complete, existing or failed, what its transfer and its duplicates were, and the regions that want it in order."""
    files = events.where(_of("request", "duplicate", "started", "transfer", "finished"))
    last = lambda kind, value: F.max_by(F.when(_of(kind), value), F.when(_of(kind), F.col("seq")))
    seen = lambda kind: F.max(F.when(_of(kind), F.col("seq")))
    wants = F.array_sort(F.collect_list(F.when(_of("request", "duplicate") & F.col("region_id").isNotNull(), F.struct("seq", "region_id"))))
    out = files.groupBy("pipeline", "key").agg(
        F.min_by(F.when(_of("request"), F.col("text")), F.when(_of("request"), F.col("seq"))).alias("url"), F.count_if(_of("duplicate")).alias("duplicates"), last("transfer", F.col("status")).alias("transfer"), last("transfer", F.col("amount")).alias("bytes"),
        last("finished", F.struct("text")).alias("_end"), seen("started").alias("_started"), seen("finished").alias("_finished"), F.array_distinct(F.transform(wants, lambda w: w["region_id"])).alias("regions"),
    )
    done = F.col("_finished").isNotNull() & (F.col("_started").isNull() | (F.col("_finished") > F.col("_started")))
    error = F.when(done, F.col("_end.text"))
    status = F.when(done & error.isNotNull(), "failed").when(done & (F.col("transfer") == "existing"), "existing").when(done, "complete").when(F.col("_started").isNotNull(), "running").otherwise("planned")
    return out.select("pipeline", "key", "url", status.alias("status"), "transfer", "bytes", "duplicates", "regions", error.alias("error"))


def region_files(events: DataFrame) -> DataFrame:
    """Per region the files that it requires, in order, and which of them are complete or failed."""
    wants = events.where(_of("request", "duplicate") & F.col("region_id").isNotNull()).groupBy("pipeline", "region_id", "key").agg(F.min("seq").alias("seq"))
    held = wants.join(file_states(events).select("pipeline", "key", "status"), ["pipeline", "key"], "left")
    listed = lambda cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("seq", "key")))), lambda w: w["key"])
    return held.groupBy("pipeline", "region_id").agg(listed(F.lit(True)).alias("required"), listed(F.col("status").isin("complete", "existing")).alias("completed"), listed(F.col("status") == "failed").alias("failed"))


def region_states(events: DataFrame) -> DataFrame:
    """Per region: pending, ready, building, complete, existing, failed or unavailable, with the error.

    A built region fails if it has an error or lacks an expected output. When the pipeline is closed, regions that are not
    final fail if a file of theirs failed, and are unavailable if none did.
    """
    own = events.where(_of("region", "ready", "building", "built") & F.col("region_id").isNotNull())
    built = F.when(_of("built"), F.col("key"))
    facts = own.groupBy("pipeline", "region_id").agg(
        F.max(_of("region") & (F.col("status") == "existing")).alias("existing"), F.max_by(F.when(~_of("region"), F.col("kind")), F.when(~_of("region"), F.col("seq"))).alias("last"),
        F.max_by(F.when(_of("built"), F.struct("text")), F.when(_of("built"), F.col("seq")))["text"].alias("said"), F.array_sort(F.array_except(F.collect_set(F.when(_of("region"), F.col("key"))), F.collect_set(built))).alias("missing"),
    )
    closed = events.where(_of("closed")).select("pipeline").distinct().withColumn("closed", F.lit(True))
    files = region_files(events).select("pipeline", "region_id", F.size("failed").alias("n_failed"))
    rows = facts.join(files, ["pipeline", "region_id"], "left").join(closed, "pipeline", "left")
    lacks = (F.col("last") == "built") & (F.size("missing") > 0)
    broken = (F.col("last") == "built") & F.col("said").isNotNull()
    over = F.coalesce("closed", F.lit(False))
    some_failed = F.coalesce("n_failed", F.lit(0)) > 0
    state = (
        F.when(F.col("existing") & F.col("last").isNull(), "existing").when(broken | lacks, "failed").when(F.col("last") == "built", "complete").when(over & some_failed, "failed").when(over, "unavailable")
        .when(F.col("last") == "building", "building").when(F.col("last") == "ready", "ready").otherwise("pending")
    )
    error = F.when(broken, F.col("said")).when(lacks, F.concat(F.lit("expected outputs were not produced: "), F.array_join("missing", ", "))).when((state == "failed") & over, F.format_string("%d required files failed", "n_failed")).when(state == "unavailable", "no source covers the region")
    return rows.select("pipeline", "region_id", state.alias("state"), error.alias("error"))


def summary(events: DataFrame) -> DataFrame:
    """Per pipeline: regions and files by state, what is left, issues, duplicates, and failed or complete once it is closed."""
    regions = region_states(events).groupBy("pipeline").agg(F.count(F.lit(1)).alias("regions"), *(F.count_if(F.col("state") == s).alias(f"regions_{s}") for s in ("pending", "ready", "building", *FINAL)), F.count_if(~F.col("state").isin("complete", "existing")).alias("regions_remaining"))
    files = file_states(events).groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("status").isin("complete", "existing")).alias("files_complete"), F.count_if(F.col("status") == "failed").alias("files_failed"), F.count_if(F.col("status") == "running").alias("files_running"),
        F.count_if(F.col("transfer") == "success").alias("downloaded"), F.count_if(F.col("transfer").isin("existing", "skipped")).alias("available"), F.sum("duplicates").alias("duplicates"),
    )
    facts = events.groupBy("pipeline").agg(F.count_if(_of("issue")).alias("issues"), F.max(F.when(_of("pipeline"), F.col("amount"))).alias("workers"), F.max(_of("planned")).alias("planned"), F.max(_of("closed")).alias("closed"), F.round(F.max("ts") - F.min("ts"), 3).alias("seconds"))
    out = facts.join(regions, "pipeline", "left").join(files, "pipeline", "left")
    out = out.na.fill(0, [c for c in out.columns if c not in ("pipeline", "planned", "closed", "workers", "seconds")])
    left = F.greatest(F.col("files") - F.col("files_complete") - F.col("files_failed"), F.lit(0).cast("long"))
    status = F.when(~F.col("closed"), F.when(F.col("planned"), "running").otherwise("planning")).when(F.col("regions_failed") + F.col("regions_unavailable") > 0, "failed").otherwise("complete")
    return out.withColumn("files_remaining", left).withColumn("status", status)


def average_active(events: DataFrame, since: DataFrame | None = None) -> DataFrame:
    """Per pipeline the time-weighted mean of active workers while any is active; with since (pipeline, ts) only after that time, as from a checkpoint."""
    steps = events.where(_of("started", "finished")).select("pipeline", "ts", "seq", F.when(_of("started"), 1).otherwise(-1).alias("delta"))
    w = Window.partitionBy("pipeline").orderBy("ts", "seq")
    active = F.greatest(F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    spans = steps.withColumn("active", active).withColumn("until", F.lead("ts").over(w)).where("until is not null")
    if since is not None:
        spans = spans.join(since.select("pipeline", F.col("ts").alias("_since")), "pipeline", "left").withColumn("ts", F.greatest("ts", F.coalesce("_since", "ts"))).where("until > ts")
    length = F.col("until") - F.col("ts")
    out = spans.where("active > 0").groupBy("pipeline").agg(F.round(F.try_divide(F.sum(F.col("active") * length), F.sum(length)), 2).alias("average_active"))
    return events.select("pipeline").distinct().join(out, "pipeline", "left").select("pipeline", F.coalesce("average_active", F.lit(0.0)).alias("average_active"))


def errors(events: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(pipeline, category, subject, error, earlier): problems of planning, files, regions and the run, and those that earlier runs left, first."""
    planning = events.where(_of("issue")).select("pipeline", F.lit("planning").alias("category"), F.coalesce("key", "region_id").alias("subject"), F.col("text").alias("error"))
    files = file_states(events).where("status = 'failed'").select("pipeline", F.lit("file"), "key", "error")
    regions = region_states(events).where("error is not null").select("pipeline", F.lit("region"), "region_id", "error")
    run = events.where(_of("failed", "interrupted")).select("pipeline", F.when(_of("failed"), "run").otherwise("interrupted"), F.lit(None).cast("string"), "text")
    now = planning.union(files).union(regions).union(run).withColumn("earlier", F.lit(False))
    return now if previous is None else previous.select("pipeline", "category", "subject", "error", F.lit(True).alias("earlier")).union(now)


def resumed(events: DataFrame, previous: DataFrame, previous_inputs: DataFrame) -> DataFrame:
    """Regions with their earlier state. What is on disk decides, the earlier record only tells; other inputs than the record's are an error.

    previous: (pipeline, region_id, state, required); previous_inputs: (pipeline, region_id, input). Required files of regions that exist already
    are kept, as their plan does not run again.
    """
    inputs = events.where(_of("region")).groupBy("pipeline", "region_id").agg(F.min("text").alias("input"))
    old = previous_inputs.select("pipeline", "region_id", F.col("input").alias("old_input"))
    pipelines = old.select("pipeline").distinct().withColumn("known", F.lit(True))
    met = inputs.join(old.withColumn("had", F.lit(True)), ["pipeline", "region_id"], "full_outer").join(pipelines, "pipeline", "left")
    fresh = F.coalesce("known", F.lit(False)) & (F.col("had").isNull() | ~F.col("input").eqNullSafe(F.col("old_input")))
    checked = met.select("pipeline", F.when(fresh, F.raise_error(F.concat(F.lit("the record belongs to other inputs: region "), F.col("region_id")))).otherwise(F.col("region_id")).alias("region_id"))
    now = checked.join(region_states(events), ["pipeline", "region_id"], "left").join(region_files(events), ["pipeline", "region_id"], "left")
    was = previous.select("pipeline", "region_id", F.col("state").alias("previous_state"), F.col("required").alias("_required"))
    required = F.when(F.col("state") == "existing", F.coalesce("required", "_required")).otherwise(F.col("required"))
    return now.join(was, ["pipeline", "region_id"], "left").select("pipeline", "region_id", "state", "previous_state", F.coalesce(required, F.array().cast("array<string>")).alias("required"))


def merged_in_order(order: DataFrame, processed: DataFrame, completed: DataFrame, key: str = "region_id") -> DataFrame:
    """Regions in their order with the result that was there before, else the one of this run. Both have (key, result)."""
    before, now = completed.select(key, F.col("result").alias("_before")), processed.select(key, F.col("result").alias("_now"))
    return order.join(before, key, "left").join(now, key, "left").select(*order.columns, F.coalesce("_before", "_now").alias("result"))


def terminal_outputs(expected: DataFrame) -> DataFrame:
    """Of the outputs that a chain of steps will give (region_id, step, product, path) the one of the last step for each product."""
    return expected.where("path is not null").groupBy("region_id", "product").agg(F.max_by("path", "step").alias("path"), F.max("step").alias("step"))


def add_assets(report: DataFrame, more: DataFrame, status: str) -> DataFrame:
    """A report (region_id, asset_id, path, status, error) with assets of one status; failures come as failures, not as assets."""
    if status not in ("success", "skipped", "reused"):
        raise ValueError(f"an asset cannot be {status}")
    return report.unionByName(more.select("region_id", "asset_id", "path", F.lit(status).alias("status"), F.lit(None).cast("string").alias("error")))


def add_failures(report: DataFrame, failures: DataFrame) -> DataFrame:
    return report.unionByName(failures.select("region_id", "asset_id", F.lit(None).cast("string").alias("path"), F.lit("failed").alias("status"), "error"))


def lines(events: DataFrame) -> DataFrame:
    """(pipeline, seq, level, line): what is told of each event, as in a log."""
    level = F.when(_of("issue"), "WARNING").when(_of("failed", "interrupted") | (_of("finished", "built") & F.col("text").isNotNull()), "ERROR").otherwise("INFO")
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in ("region_id", "key", "status", "text")]
    stamp = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return events.select("pipeline", "seq", level.alias("level"), F.concat_ws(" ", stamp, F.concat(F.lit("["), "kind", F.lit("]")), *parts).alias("line"))


# Checkpoints


def document(events: DataFrame, reason: str, previous: dict[str, Any] | None = None) -> dict[str, Any]:
    """The state as one document: a line per region and file, as the run's own record has it. For runs that a driver follows."""
    rows = lambda frame: [r.asDict(recursive=True) for r in frame.collect()]
    inputs = events.where(_of("region")).groupBy("pipeline", "region_id").agg(F.min("text").alias("input"))
    tifs = region_states(events).join(region_files(events), ["pipeline", "region_id"], "left").join(inputs, ["pipeline", "region_id"], "left")
    status = events.where(_of("failed", "interrupted", "complete")).agg(F.max_by("kind", "seq")).first()[0]
    old = previous or {}
    return {
        "schema_version": VERSION, "status": status or "running", "resume_count": int(old.get("resume_count") or 0) + bool(previous), "last_checkpoint": {"reason": reason},
        "summary": rows(summary(events)), "regions": rows(tifs.orderBy("pipeline", "region_id")), "files": rows(file_states(events).orderBy("pipeline", "key")), "errors": rows(errors(events).drop("earlier")),
        "previous_errors": [*(old.get("previous_errors") or []), *(old.get("errors") or [])],
    }


def save(state: dict[str, Any], path: str) -> None:
    """The document appears whole or not at all."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(state, f, ensure_ascii=False, indent=2)
    os.replace(part, path)


def load(path: str, overwrite: bool = False) -> dict[str, Any] | None:
    """The record of an earlier run, if there is one to go on from; one that cannot be read or is of another version is an error."""
    if overwrite or not os.path.isfile(path):
        return None
    try:
        with open(path, encoding="utf-8") as f:
            state = json.load(f)
    except (OSError, json.JSONDecodeError) as broken:
        raise ValueError(f"{path} cannot be gone on from: {broken}; repair it, choose another or overwrite") from broken
    if state.get("schema_version") != VERSION:
        raise ValueError(f"{path} is of another version; choose another or overwrite")
    return state


def as_frames(spark: SparkSession, state: dict[str, Any]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """previous and previous_inputs for resumed, and previous for errors."""
    regions = [(r["pipeline"], r["region_id"], r["state"], r.get("required") or [], r.get("input")) for r in state.get("regions", [])]
    found = spark.createDataFrame(regions, "pipeline string, region_id string, state string, required array<string>, input string")
    old = [(e["pipeline"], e["category"], e["subject"], e["error"]) for e in (*state.get("previous_errors", []), *state.get("errors", []))]
    return found.drop("input"), found.select("pipeline", "region_id", "input"), spark.createDataFrame(old, "pipeline string, category string, subject string, error string")


def due(batch: DataFrame, before: dict[str, int], totals: dict[str, int], done: dict[str, int]) -> list[str]:
    """Why a batch of events makes a checkpoint due: urgent kinds, errors, and further tenths of the regions that are done. before is brought up to date."""
    why = [r["kind"] for r in batch.where(_of(*URGENT) | (_of("finished", "built") & F.col("text").isNotNull())).select("kind").distinct().orderBy("kind").collect()]
    for name, total in totals.items():
        tenth = 10 * done.get(name, 0) // total if total else 10
        if tenth > before.get(name, 0):
            before[name] = tenth
            why.append(f"{10 * tenth}_percent")
    return why


def checkpointing(log: Callable[[], DataFrame], path: str, previous: dict[str, Any] | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over a stream of events: saves the state when due. log gives all events so far."""
    reached: dict[str, int] = {}

    def each(batch: DataFrame, _: int) -> None:
        states = region_states(log()).groupBy("pipeline").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("state").isin("complete", "existing")).alias("done")).collect()
        why = due(batch, reached, {r["pipeline"]: r["n"] for r in states}, {r["pipeline"]: r["done"] for r in states})
        if why:
            save(document(log(), ", ".join(why), previous), path)

    return each
