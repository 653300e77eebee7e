"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened for numpy traversal.

Every statistic is taken from the whole text. The trees are trained on a bounded sample of labelled documents
whose statistics alone reach the driver.

Defined cases: a null text counts as the empty text and is scored like any other; without labels every score is
0.5. A label of null is no label; of repeated labels of a document the largest counts. Repeated documents are scored
row by row, an empty table gives no rows, and only the columns named are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.boosting import Forest, train
from geoloom.llm.common import pieces, small_batches, texts, utf8

#: Bound of the labelled documents that are learned from.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3

# Classes of bytes: 0 other, 1 A-Z, 2 a-z, 3 digit, 4 blank, 5 line end, 6 sentence end, 7 other mark, 8 beyond ASCII
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 8 if _b > 127 else 1 if _c.isupper() else 2 if _c.islower() else 3 if _c.isdigit() else 5 if _c == "\n" else 4 if _c.isspace() else 6 if _c in ".!?" else 7 if _c.isprintable() else 0
CLASSES = 9
STATISTICS = ("log_bytes", "log_words", "word_length", "longest_word", "capitals", "digits", "blanks", "sentence_ends", "marks", "beyond_ascii", "controls", "distinct_words", "top_word", "top_pair", "equal_neighbours", "distinct_lines", "copied_line_bytes", "entropy", "deflated", "marked_words", "bare_words", "line_ends_marked", "first_words")


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text."""
    raw, starts = utf8(column)
    n = len(starts) - 1
    size = np.diff(starts)
    of = np.repeat(np.arange(n), size)
    classes = np.bincount(of * CLASSES + _CLASS[raw], minlength=n * CLASSES).reshape(n, CLASSES)
    out = np.zeros((n, len(STATISTICS)))
    for i, text in enumerate(texts(column)):
        if not size[i]:
            continue
        c, total = classes[i], float(size[i])
        body = raw[starts[i] : starts[i + 1]]
        share = np.bincount(body, minlength=256)
        share = share[share > 0] / total
        words = text.split()
        count = Counter(words)
        pairs = Counter(zip(words, words[1:]))
        lines = [x for x in text.split("\n") if x]
        held = Counter(lines)
        m = max(1, len(words))
        letters = max(1, c[1] + c[2])
        out[i] = (
            math.log1p(total), math.log1p(len(words)), sum(map(len, words)) / m, math.log1p(max(map(len, words), default=0)),
            c[1] / letters, c[3] / total, c[4] / total, c[6] / total, c[7] / total, c[8] / total, c[0] / total,
            len(count) / m, max(count.values(), default=0) / m, max(pairs.values(), default=0) / m, sum(k for (a, b), k in pairs.items() if a == b) / m,
            len(held) / max(1, len(lines)), sum((k - 1) * len(x) for x, k in held.items()) / total, float(-(share * np.log2(share)).sum()), len(zlib.compress(body, 1)) / total,
            sum(k for w, k in count.items() if not w[-1].isalnum()) / m, sum(k for w, k in count.items() if not any(map(str.isalpha, w))) / m,
            sum(x[-1] in ".!?" for x in lines) / max(1, len(lines)), sum(k for w, k in count.items() if w[0].isupper()) / m,
        )
    return out


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of a sample, chosen by a hash of the id, of the rows of labels that fit learn."""
    small_batches(docs.sparkSession)
    known = labels.where(learn & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    n = labels.where(learn & F.col("quality").isNotNull()).agg(F.count("doc_id")).first()[0]
    share = min(1.0, sample_rows / max(1, n))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    both = docs.select("doc_id", "text").where(chosen).join(known.where(chosen), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 8 << 20):
            values = statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(values.tolist(), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    rows = sorted(map(tuple, both.mapInArrow(run, "doc_id long, quality int, x array<double>").limit(2 * sample_rows).collect()))
    return np.array([r[2] for r in rows]).reshape(-1, len(STATISTICS)), np.array([r[1] for r in rows], float)


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS) -> Forest:
    x, y = labelled(docs, labels, learn, sample_rows)
    return train(x, y)


def score(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted by row of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(forest)  # its size is fixed by trees and depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 8 << 20):
            p = shipped.value.probability(statistics(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
