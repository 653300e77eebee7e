"""Sharding by size-tiered compaction, with DataFrame functions alone.

Arrivals are appended as small immutable Parquet shards, one a task, without a shuffle; scans are split at ARRIVAL_BYTES
meanwhile, so that arrivals are small however large the input's files are. A shard's tier is the
power of fan_in to which its size exceeds the smallest size. When a tier holds fan_in shards or more, runs of them
are merged into files of the target size: a run is the longest sequence of a tier's shards, in order of arrival,
whose sizes sum to the target at most. Merging reads whole files and writes one file a run, again without a
shuffle.

The manifest of a version is a Parquet folder with a row per live shard. A version is committed by a numbered file that names
the folder. Spark's checkpoint file manager creates it, which is atomic for the store at hand (a rename, or
an upload that the store publishes as a whole) and fails if another writer has taken the number. Readers use the latest
version and never list data, so files of failed or lost tasks stay unseen. Files that a version replaced stay for readers of
the RETAINED versions before it and go with the first commit after.

Defined cases: all columns are carried as they are, nulls included, and repeated rows stay. A column may have any name but
_metadata, which hides Spark's own of that name and is refused. An empty table leaves a manifest without shards and gives no
rows. A text longer than the target is in a shard of its own size: rows are never cut. What reaches the driver is a line per file that is
to be merged, PLANNED at a time, not per row.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import fresh_dir

TARGET_BYTES, LEAST_BYTES, FAN_IN = 128 << 20, 1 << 20, 4
ARRIVAL_BYTES = 16 << 20
#: Runs that are merged for one version of the manifest, jobs at a time, and shards that the driver plans with at a time.
RUNS_A_VERSION, JOBS, PLANNED = 256, 16, 20_000
#: Versions before the last whose files are still there.
RETAINED = 1
SHARDS = "shard_id long, file string, bytes long, rows long, arrived long"


@dataclass
class Shard:
    shard_id: int
    file: str
    bytes: int
    rows: int
    arrived: int  # of merged shards the first


class Store:
    """A folder with data files and numbered manifests."""

    def __init__(self, spark: SparkSession, folder: str, target_bytes: int = TARGET_BYTES, least_bytes: int = LEAST_BYTES, fan_in: int = FAN_IN, arrival_bytes: int = ARRIVAL_BYTES):
        self.spark, self.folder = spark, folder
        self.target, self.least, self.fan_in, self.arrival = target_bytes, least_bytes, fan_in, arrival_bytes
        self.jvm = spark._jvm
        self.fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(f"{folder}/versions"))

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def tier(self, size: int) -> int:
        return 0 if size < self.least else 1 + int(math.log(size / self.least, self.fan_in))

    # manifests

    def version(self) -> int:
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(f"{self.folder}/versions"))]
        return max((int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit()), default=0)

    def _named(self, version: int) -> str:
        return f"{self.folder}/versions/v{version:08}"

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live shards of a version, by default the last."""
        version = self.version() if version is None else version
        if not version:
            return self._lines([])
        stream = self.fs.open(self._path(self._named(version)))
        named = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return self.spark.read.schema(SHARDS).parquet(f"{self.folder}/manifest/{named}")

    def shards(self, version: int | None = None) -> list[Shard]:
        """For tools and tests: all lines of a manifest."""
        return [Shard(**r.asDict()) for r in self.manifest(version).orderBy("arrived").collect()]

    def _lines(self, shards: list[Shard]) -> DataFrame:
        text = json.dumps([asdict(s) for s in shards])
        return self.spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(': '.join(c.split()) for c in SHARDS.split(', '))}>>")))

    def commit(self, shards: DataFrame, version: int) -> None:
        """Makes version visible as a whole; raises if another writer was first."""
        name = uuid.uuid4().hex
        shards.write.parquet(f"{self.folder}/manifest/{name}")
        place = self._path(self._named(version))
        manager = self.jvm.org.apache.spark.sql.execution.streaming.checkpointing.CheckpointFileManager.create(place.getParent(), self.spark._jsc.hadoopConfiguration())
        try:
            if manager.exists(place):
                raise FileExistsError(str(place))
            stream = manager.createAtomic(place, False)
            stream.write(name.encode())
            stream.close()
        except Exception as failed:  # py4j wraps what the store throws
            if self.fs.exists(place):
                raise RuntimeError(f"version {version} was committed by another writer") from failed
            raise
        self._expire(version)

    def _expire(self, version: int) -> None:
        """Deletes the files that the oldest retained version was the first to do without."""
        first = version - RETAINED
        if first < 2:
            return
        gone = self.manifest(first - 1).join(self.manifest(first), "file", "left_anti").select("file")
        for r in gone.toLocalIterator():
            self.fs.delete(self._path(r["file"]), False)

    # data

    @contextmanager
    def _small_splits(self) -> Iterator[None]:
        name = "spark.sql.files.maxPartitionBytes"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, str(self.arrival))
        try:
            yield
        finally:
            self.spark.conf.set(name, before)

    def _write(self, frame: DataFrame) -> DataFrame:
        """(file, bytes, rows) of each new file with rows. Each write has its own folder."""
        folder = f"{self.folder}/data/{uuid.uuid4().hex}"
        frame.write.parquet(folder)
        return self.spark.read.schema(frame.schema).parquet(folder).groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))

    def append(self, arrivals: DataFrame) -> int:
        """Adds the rows as small shards, one a task, and returns the new version."""
        if "_metadata" in arrivals.columns:
            raise ValueError("a column named _metadata hides the files' own")
        version = self.version()
        before = self.manifest(version)
        with self._small_splits():
            new = self._write(arrivals)
        top = (before.agg(F.max("shard_id")).first()[0] if version else None) or 0
        number = F.lit(top + 1) + F.monotonically_increasing_id()  # in the order of tasks
        self.commit(before.unionByName(new.orderBy("file").withColumn("shard_id", number).withColumn("arrived", number).select(*before.columns)), version + 1)
        return version + 1

    def _tier(self) -> Column:
        return F.when(F.col("bytes") < self.least, 0).otherwise(1 + F.floor(F.log(F.col("bytes") / self.least) / math.log(self.fan_in))).cast("int")

    def open_shards(self) -> list[Shard]:
        """Shards below the target in tiers that are full, the first PLANNED by arrival."""
        small = self.manifest().where(F.col("bytes") < self.target).withColumn("tier", self._tier())
        full = small.groupBy("tier").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= self.fan_in)
        rows = small.join(full, "tier", "left_semi").orderBy("arrived").limit(PLANNED).drop("tier").collect()
        return [Shard(**r.asDict()) for r in rows]

    def runs(self, shards: list[Shard]) -> list[list[Shard]]:
        """What is to be merged now."""
        tiers: dict[int, list[Shard]] = {}
        for s in sorted(shards, key=lambda s: s.arrived):
            if s.bytes < self.target:
                tiers.setdefault(self.tier(s.bytes), []).append(s)
        out = []
        for own in tiers.values():
            if len(own) < self.fan_in:
                continue
            run: list[Shard] = []
            for s in [*own, None]:
                if s is None or run and sum(r.bytes for r in run) + s.bytes > self.target:
                    if len(run) > 1:
                        out.append(run)
                    run = []
                if s is not None:
                    run.append(s)
        return out

    def compact(self) -> int:
        """Merges until no tier is full; returns the last version."""
        while runs := self.runs(self.open_shards())[:RUNS_A_VERSION]:
            version, shards = self.version(), self.manifest()
            schema = self.spark.read.parquet(runs[0][0].file).schema

            def merge(run: list[Shard], schema=schema) -> list:
                return self._write(self.spark.read.schema(schema).parquet(*(s.file for s in run)).coalesce(1)).collect()

            with ThreadPoolExecutor(JOBS) as jobs:  # a job a run, some at a time
                new = [files[0] if len(files) == 1 else None for files in jobs.map(merge, runs)]
            if any(n is None or n["rows"] != sum(s.rows for s in run) for n, run in zip(new, runs, strict=True)):
                raise RuntimeError("a merged file does not hold the rows of its run")
            top = shards.agg(F.max("shard_id")).first()[0] + 1
            merged = [Shard(top + k, n["file"], n["bytes"], n["rows"], min(s.arrived for s in run)) for k, (n, run) in enumerate(zip(new, runs, strict=True))]
            gone = self._lines([s for run in runs for s in run]).select("shard_id")
            self.commit(shards.join(gone, "shard_id", "left_anti").unionByName(self._lines(merged)).coalesce(1), version + 1)
        return self.version()

    def read(self, version: int | None = None) -> DataFrame | None:
        """All rows of a version, with the hidden column _metadata to tell files apart; None if there are none."""
        files = [r["file"] for r in self.manifest(version).select("file").toLocalIterator()]
        return self.spark.read.parquet(*files) if files else None

    def placement(self, id_column: str = "doc_id") -> DataFrame | None:
        """(doc_id, shard_id, tier, shard_rows, shard_bytes, version) by row, from the live files."""
        version = self.version()
        rows = self.read(version)
        if rows is None:
            return None
        live = self.manifest(version).select(F.col("file").alias("_file"), "shard_id", self._tier().alias("tier"), F.col("rows").alias("shard_rows"), F.col("bytes").alias("shard_bytes"))
        placed = rows.select(F.col(id_column).alias("doc_id"), F.col("_metadata.file_path").alias("_file"))
        return placed.join(live, "_file").select("doc_id", "shard_id", "tier", "shard_rows", "shard_bytes", F.lit(version).alias("version"))


def shard(docs: DataFrame, id_column: str = "doc_id", **settings: int) -> DataFrame:
    """Appends docs to a new store in the shared folder, compacts it and gives each row's place."""
    spark = docs.sparkSession
    store = Store(spark, fresh_dir(spark, "shards"), **settings)
    store.append(docs)
    store.compact()
    placed = store.placement(id_column)
    if placed is None:
        kind = docs.schema[id_column].dataType.simpleString()
        return spark.sql(f"SELECT cast(null AS {kind}) AS doc_id, 0L AS shard_id, 0 AS tier, 0L AS shard_rows, 0L AS shard_bytes, 0 AS version WHERE false")
    return placed
