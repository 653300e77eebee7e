"""Acquisition as two streams: requests become files, and regions whose files are all there are processed while others still wait.

Requests lie in small files in a folder, in their order; the first stream takes one such file at a time, so that no more
requests are under way than a few for each worker. What came is appended to a table that the second stream follows: it publishes each region
once and hands it to the steps. Both go on from their checkpoints, and what is on disk is not fetched again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoloom.sources import download
from geoloom.streaming import ledger

#: Requests under way for each worker.
AHEAD = 4
REQUESTS = "filename string, url string, regions array<string>, ordinal long"


def write_requests(requests: DataFrame, folder: str, workers: int) -> None:
    """Requests (filename, url, regions, ordinal), a file each, in order, in files of at most AHEAD * workers; needs and closings of regions go into the ledger's folder beside."""
    ordered = requests.select(*(c.split()[0] for c in REQUESTS.split(", "))).repartitionByRange(1, "ordinal").sortWithinPartitions("ordinal")  # a plan's rows, written in order
    ordered.write.option("maxRecordsPerFile", AHEAD * workers).mode("append").parquet(f"{folder}/requests")
    needs = requests.select(F.explode("regions").alias("region_id"), (F.col("ordinal") * 2).alias("seq"), F.lit("need").alias("kind"), "filename")
    closed = needs.groupBy("region_id").agg((F.max("seq") + 1).alias("seq")).select("region_id", "seq", F.lit("closed").alias("kind"), F.lit(None).cast("string").alias("filename"))
    needs.unionByName(closed).write.mode("append").parquet(f"{folder}/ledger")


def fetch_stream(spark: SparkSession, folder: str, target: str, workers: int = 4, retries: int = 3, delay: float = 2.0) -> StreamingQuery:
    """The first stream: files into target, and an event for each region that waits for one into the ledger's folder."""
    stream = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/requests")

    def each(batch: DataFrame, number: int) -> None:
        got = download.download(batch, target, retries, delay, workers=workers)
        ended = got.join(batch.select("filename", "regions", "ordinal"), "filename")
        events = ended.select(F.explode("regions").alias("region_id"), (F.col("ordinal") * 2 + (1 << 40)).alias("seq"), F.when(F.col("status") == "failed", "failed").otherwise("done").alias("kind"), "filename")
        events.write.mode("overwrite").parquet(f"{folder}/ended/batch={number}")  # a batch that runs again writes the same

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/checkpoints/fetch").start()


def ready_stream(spark: SparkSession, folder: str, process: Callable[[DataFrame], None]) -> StreamingQuery:
    """The second stream: process gets (region_id, state, assets) of regions as they become ready, once each."""
    wants = spark.readStream.schema(ledger.EVENTS).parquet(f"{folder}/ledger")
    ends = spark.readStream.schema(ledger.EVENTS).option("recursiveFileLookup", "true").parquet(f"{folder}/ended")
    ready = ledger.publish(wants.unionByName(ends))
    return ready.writeStream.foreachBatch(lambda batch, _: process(batch)).option("checkpointLocation", f"{folder}/checkpoints/ready").start()
