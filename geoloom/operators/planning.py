"""Requests and catalogues: deduplication, latest and preferred rows, checks, batches and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_requests(requests: DataFrame) -> DataFrame:
    """One row a destination (filename): the first request by ordinal, the regions of all, how many were dropped."""
    first = F.min_by(F.struct(*(c for c in requests.columns if c not in ("filename", "target_region_ids"))), "ordinal")
    out = requests.groupBy("filename").agg(first.alias("first"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("target_region_ids")))).alias("targets"), (F.count("*") - 1).alias("duplicates"))
    return out.select("filename", "first.*", "targets", "duplicates")


def targets_in_order(rows: DataFrame, key: str, target: str, ordinal: str) -> DataFrame:
    """Distinct targets of a key in the order in which they came first."""
    first = rows.groupBy(key, target).agg(F.min(ordinal).alias("_o"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", target))), lambda s: s[target]).alias("targets"))


def latest(rows: DataFrame, key: list[str], date: str, ordinal: str) -> DataFrame:
    """Per key the row with the greatest date; of equal dates the first; a null date is the least. Rows with a null key all stay."""
    named = F.lit(True)
    for k in key:
        named = named & F.col(k).isNotNull()
    values = [c for c in rows.columns if c not in key]
    best = F.max_by(F.struct(*values), F.struct(F.coalesce(F.col(date).cast("string"), F.lit("")), -F.col(ordinal)))
    top = rows.where(named).groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*").select(*rows.columns)
    return top.union(rows.where(~named))


def link_counts(names: DataFrame, group: str) -> DataFrame:
    """Per group: distinct files, repeated names, placeholders. names: (group, filename, placeholder)."""
    per = names.groupBy(group, "filename").agg(F.count("*").alias("n"), F.max("placeholder").alias("placeholder"))
    real = ~F.col("placeholder")
    return per.groupBy(group).agg(F.count_if(real).alias("files"), F.sum(F.when(real, F.col("n") - 1).otherwise(0)).alias("duplicates"), F.sum(F.when(F.col("placeholder"), F.col("n")).otherwise(0)).alias("placeholders"))


def conflicts(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that stand for more than one value."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def single_value(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Groups with whether all rows have one value."""
    return rows.groupBy(group).agg((F.count_distinct(value) == 1).alias("single"), F.min(value).alias("value"))


def delivery_version(text: Column) -> list[Column]:
    """Year and number of names that end in /2023_1; -1 where they do not."""
    part = lambda k: F.coalesce(F.regexp_extract(text, r"/(\d{4})_(\d+)$", k).try_cast("int"), F.lit(-1))
    return [part(1), part(2)]


def preferred(rows: DataFrame, key: list[str], wanted: Column, name: str) -> DataFrame:
    """Per key a row for which wanted holds, else any; the least name decides."""
    order = F.struct((~wanted).alias("_w"), F.col(name))
    values = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*values), order).alias("_row")).select(*key, "_row.*").select(*rows.columns)


def nearest_release(requests: DataFrame, releases: DataFrame, request: str, date: str) -> DataFrame:
    """For each requested date the release nearest to it, of two the earlier.

    An as-of look-up on both sides: one union, sorted per partition by date, carries the last and the next release
    along. Requests are dealt by month, each month with its neighbours' edge releases, so no task holds all dates.
    """
    marked = requests.select(request, F.col("wanted"), F.lit(None).cast("date").alias("r")).union(releases.select(F.lit(None).cast(requests.schema[request].dataType), F.col(date), F.col(date)))
    month = lambda c: F.year(c) * 12 + F.month(c)
    edges = releases.select(F.col(date).alias("d")).groupBy(month("d").alias("y")).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    months = requests.select(month("wanted").alias("q")).distinct().join(edges, F.col("q") == F.col("y"), "full_outer").select(F.coalesce("q", "y").alias("q"), "lo", "hi")
    by_month = Window.orderBy("q")  # as many rows as there are months
    near = months.select("q", F.last("hi", ignorenulls=True).over(by_month.rowsBetween(Window.unboundedPreceding, -1)).alias("before_month"), F.first("lo", ignorenulls=True).over(by_month.rowsBetween(1, Window.unboundedFollowing)).alias("after_month"))
    w = Window.partitionBy("q").orderBy("wanted", F.col("r").isNull())
    both = marked.withColumn("q", month("wanted"))
    last = F.last("r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    back = Window.partitionBy("q").orderBy(F.desc("wanted"), F.col("r").isNull())  # a growing frame, where one up to the end would be read again for each row
    following = F.last("r", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("last", last).withColumn("following", following).where(F.col(request).isNotNull()).join(near, "q", "left")
    before, after = F.coalesce("last", "before_month"), F.coalesce("following", "after_month")
    gap = lambda c: F.abs(F.datediff(c, F.col("wanted")))
    pick = F.when(after.isNull() | (gap(before) <= gap(after)), before).otherwise(after)
    return found.select(request, "wanted", pick.alias("release"))


def ranked(rows: DataFrame, date: str, ordinal: str, group: list[str] | None = None) -> DataFrame:
    """Newest first: by the date's text, nulls last, of equals in the order in which they came."""
    w = Window.partitionBy(*(group or [])).orderBy(F.coalesce(F.col(date).cast("string"), F.lit("")).desc(), ordinal)
    return rows.withColumn("rank", F.row_number().over(w))


def batches(rows: DataFrame, order: str, size: int, group: str) -> DataFrame:
    """Numbers fixed-size batches inside each group."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1) / size))


def first_middle_last(rows: DataFrame, order: str, group: str) -> DataFrame:
    """Rows 1, n // 2 + 1 and n of each group."""
    w = Window.partitionBy(group)
    marked = rows.withColumn("_k", F.row_number().over(w.orderBy(order))).withColumn("_n", F.count("*").over(w))
    return marked.where((F.col("_k") == 1) | (F.col("_k") == F.floor(F.col("_n") / 2) + 1) | (F.col("_k") == F.col("_n"))).drop("_k", "_n")


def head_and_tail(rows: DataFrame, order: str, group: str, head: int = 17, tail: int = 3) -> DataFrame:
    """The first and last rows of each group, all of a group that is not longer than both."""
    w = Window.partitionBy(group)
    marked = rows.withColumn("_k", F.row_number().over(w.orderBy(order))).withColumn("_n", F.count("*").over(w))
    return marked.where((F.col("_k") <= head) | (F.col("_k") > F.col("_n") - tail)).drop("_k", "_n")


def examples(rows: DataFrame, group: str, value: str, limit: int = 10) -> DataFrame:
    """Up to limit least values of a group, and how many more there are."""
    w = Window.partitionBy(group).orderBy(value)
    each = rows.select(group, value).distinct()
    top = each.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= limit).groupBy(group).agg(F.array_sort(F.collect_list(value)).alias("examples"))
    return top.join(each.groupBy(group).agg(F.greatest(F.count("*") - limit, F.lit(0)).alias("more")), group)


def groups_in_order(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Numbers keys by their first appearance; keys are few (folders, states), rows may be many."""
    first = rows.groupBy(key).agg(F.min(ordinal).alias("first"), F.count("*").alias("n"))
    return first.withColumn("number", F.dense_rank().over(Window.orderBy("first")))


def match_rules(rows: DataFrame, rules: list[tuple[str, dict[str, str]]]) -> DataFrame:
    """rules: name and patterns by column. Adds the names of all rules of which every pattern is found, without regard to case.

    Rules are a bounded catalogue of the configuration; they become literal expressions, whose patterns are compiled once.
    """
    hits = []
    for name, patterns in rules:
        fits = F.lit(True)
        for column, pattern in patterns.items():
            fits = fits & F.coalesce(F.col(column), F.lit("")).rlike(f"(?i){pattern}")
        hits.append(F.when(fits, F.lit(name)))
    return rows.withColumn("rules", F.array_compact(F.array(*hits))).withColumn("ambiguous", F.size("rules") > 1)


def priority_subset(rows: DataFrame, group: str, rank: str, targets: str) -> DataFrame:
    """Newest first, the rows that add a target not seen before in their group: for each target its first row."""
    each = rows.select(group, rank, F.explode(targets).alias("target"))
    return each.groupBy(group, "target").agg(F.min(rank).alias(rank)).groupBy(group, rank).agg(F.count("*").alias("added"))
