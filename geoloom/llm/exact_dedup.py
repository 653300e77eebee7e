"""Exact deduplication by content sort.

Texts are normalised (only A-Z are lower-cased), copies inside a task are combined first, sampled splitters
range-partition the normalised bytes, Spark's external sort places equal texts adjacent, and one pass over the
sorted rows compares each text with its neighbour in full. The groups are then joined back to the documents.

Defined cases: a null text counts as the empty text, and all empty texts form one group. Of equal texts the
largest (or smallest) id stays; a null id loses against any other. Rows that repeat both id and text are one
group, of which exactly one row stays. An empty table gives no rows. Only the id and text columns are read, so
other columns cannot clash. The input must be a table, or a plan that gives the same rows in the same order again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import small_batches, texts

#: Bytes of the sort key that are compared before the digest: splitters stay small however long texts are.
KEY_BYTES = 64
#: Bytes of texts that a task holds while it combines copies.
COMBINE_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _combine(keep: str):
    better = max if keep == "largest" else min
    worst = -(1 << 63) if keep == "largest" else (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = held.values()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array(list(held), pa.string()), pa.array([r[1][0] for r in rows], pa.int64()), pa.array([r[1][1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                names=["key", "norm", "rank_id", "row", "n"],
            )

        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, text, row in zip(ids, texts(batch.column(1)), rows, strict=True):
                mine = (worst if i is None else i, row)
                got = held.get(text)
                if got is None:
                    raw = text.encode()
                    held[text] = [raw[:KEY_BYTES] + hashlib.sha256(raw).digest(), mine, 1]
                    size += len(raw)
                else:
                    got[1], got[2] = better(got[1], mine), got[2] + 1
            if size > COMBINE_BYTES:
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()

    return run


def _neighbours(keep: str):
    better = max if keep == "largest" else min

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, best, count, key = None, None, 0, b""
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for k, norm, i, row, n in zip(*columns, strict=True):
                if norm == text:
                    best, count = better(best, (i, row)), count + n
                    continue
                if count > 1:
                    out.append((key[-32:], *best, count))
                text, best, count, key = norm, (i, row), n, k
            yield _groups(out)
        yield _groups([(key[-32:], *best, count)] if count > 1 else [])

    return run


def _groups(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names=["digest", "keep_rank", "keep_row", "group_size"])


def duplicate_groups(rows: DataFrame, keep: str) -> DataFrame:
    """(digest, keep_rank, keep_row, group_size) of each text that occurs more than once. rows: (id, norm, row)."""
    combined = rows.mapInArrow(_combine(keep), "key binary, norm string, rank_id long, row long, n long")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = combined.repartitionByRange(parts, "key").sortWithinPartitions("key", "norm")
    return ordered.mapInArrow(_neighbours(keep), "digest binary, keep_rank long, keep_row long, group_size long")


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and row_id, the row's place in the input.

    keep: "smallest" or "largest", the id that stays of each group of equal texts.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is {keep!r}")
    small_batches(docs.sparkSession)
    worst = -(1 << 63) if keep == "largest" else (1 << 63) - 1
    rows = docs.select(F.col(id_column).cast("long").alias("id"), normalised(F.col(text_column)).alias("norm"), F.monotonically_increasing_id().alias("row"))
    groups = duplicate_groups(rows, keep)
    each = rows.select("id", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"), "row")
    joined = each.join(groups, "digest", "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.nullif(F.col("keep_rank"), F.lit(worst)))
    return joined.select(
        F.col("id").alias("doc_id"),
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast(T.LongType())).alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("row").alias("row_id"),
    )
