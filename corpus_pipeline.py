"""A training-data pipeline in five stages, each one of the operators of geoloom.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Defined cases are those of the operators; rows
with a null id are never near-duplicates, and of rows that repeat an id in one group one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import bpe, decontaminate, exact_dedup, jaccard_join, langid
from geoloom.llm.common import fresh_dir, id_fold, table
from geoloom.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row in one column beside the text, so that no name can clash with those an operator adds."""
    return docs.select(F.struct("*").alias("_row"), F.col("text"))


def _rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose place in the table is in gone (row_id)."""
    names = docs.columns
    placed = docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_at"))
    left = placed.join(gone.select(F.col("row_id").alias("_at")), "_at", "left_anti")
    return left.select(*(F.col("_row").getField(n).alias(n) for n in names))


def _unpacked(marked: DataFrame, keep: Column, names: list[str]) -> DataFrame:
    return marked.where(keep).select(*(F.col("_row").getField(n).alias(n) for n in names))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    model = langid.fit_languages(docs, id_fold("doc_id", 4) != 2)
    return _unpacked(langid.identify(_packed(docs), model, ["_row"]), ~F.col("rejected"), docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return _rows(docs, exact_dedup.exact_dedup(docs, keep="smallest").where("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    found = jaccard_join.jaccard_join(docs).where("n_shingles > 0 and doc_id is not null")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "row_id")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return _rows(docs, found.join(first, "component_id").where("row_id <> first.row_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark, or the same with other parameters, go."""
    return _rows(docs, decontaminate.contaminated_rows(docs, table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, how many there are and a digest of what they decode to."""
    out = bpe.encode(docs, tokenizer_path(spark))
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

#: Learned languages and template matches are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = fresh_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
