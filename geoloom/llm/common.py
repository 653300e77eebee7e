"""What the operators of this subpackage share: tables, Arrow text buffers, the shared folder and checkpoints."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch; a row that is larger is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 512, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of the Arrow batches that Python workers get."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one machine's tests get one of their own; a cluster must name it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = f"file://{tempfile.mkdtemp(prefix='geoloom-shared-')}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named if "://" in named or named.startswith("file:") else f"file://{named}"


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/geoloom-{what}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared folder, which outlive executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def id_fold(column: str, folds: int) -> Column:
    """crc32 of the id as text modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(folds)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of an Arrow column, and where each starts (one offset more than strings); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = 8 if pa.types.is_large_string(column.type) else 4
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide == 8 else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


def pieces(batches: Iterator[pa.RecordBatch], limit: int, tidy: bool = True) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about limit bytes at most, or one row."""
    for batch in batches:
        at, n = 0, batch.num_rows
        step = n if batch.nbytes <= limit else max(1, int(n * limit / batch.nbytes))
        while at < n:
            yield batch.slice(at, step)
            at += step
    if tidy:
        give_back()


def give_back() -> None:
    """Hands memory that a task has freed back to the system, as the worker lives on for other operators' tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


#: Bits of a sieve: 2 MB however many values it gets.
SIEVE_BITS = 24


def sieve_place(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(1 << SIEVE_BITS))


def marked_places(places: DataFrame) -> np.ndarray:
    """From (p), places below 2**SIEVE_BITS: which of them occur."""
    bits = places.selectExpr("shiftright(p, 6) AS w", "shiftleft(1L, cast(p % 64 AS int)) AS b").groupBy("w").agg(F.bit_or("b").alias("b"))
    found = bits.toArrow()  # at most 2**18 rows, 4 MB as columns
    table = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    table[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return np.unpackbits(table.view(np.uint8), bitorder="little").view(bool)


def sieve(df: DataFrame, column: str) -> np.ndarray:
    """Which places of a table of fixed size the values of a column fall on. It spares work ahead of a join and decides nothing."""
    return marked_places(df.select(sieve_place(F.col(column)).alias("p")))


def in_one_task(rows: DataFrame, make: Callable[[list[pa.RecordBatch]], bytes], part_bytes: int = 1 << 20) -> bytes:
    """What make builds of all rows, in an executor's task. For bounded rows and results only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make(list(batches))
        cut = range(0, len(made), part_bytes)
        yield pa.RecordBatch.from_arrays([pa.array(list(range(len(cut))), pa.int64()), pa.array([made[at : at + part_bytes] for at in cut], pa.binary())], names=["k", "part"])
        give_back()

    parts = rows.repartition(1).mapInArrow(run, "k long, part binary").collect()
    return b"".join(r["part"] for r in sorted(parts, key=lambda r: r["k"]))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (xor-shift-multiply finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x
