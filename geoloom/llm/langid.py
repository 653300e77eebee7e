"""Language identification: averaged hashed subword embeddings with a linear softmax and calibrated rejection.

Subwords are byte trigrams and four-grams of words (letters lower-cased for A-Z, every other ASCII character a
blank), hashed into buckets. A text is the mean of its subwords' embeddings; a linear softmax scores languages.
Embeddings and softmax are trained together by stochastic gradient descent in numpy, on a bounded sample. As
mean and softmax input are linear, prediction multiplies embeddings and softmax once into a table of logits per
bucket. A temperature fitted on texts kept out of training calibrates the scores. The rejection threshold is a low
quantile of the scores of right predictions on those texts and excerpts of them, by the number of different
subwords: a few tell little, so a text that is short or repeats itself needs a lower score than a long one.

Defined cases: a null text, an empty one, or one without a letter is `und` with score 0. Without any labelled
row (or an empty table) there is no model and every text is `und`. A null id counts as the empty text in folds.
Very long texts are scored whole, in bounded batches. Ties between languages go to the first in sorted order. Repeated rows
are treated alike, one by one. Columns may have any names; kept ones that are called like a result give way to it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.common import in_one_task, pieces, small_batches, utf8

UNKNOWN = "und"
BITS, WIDTH = 16, 8
#: Bound of the training sample: rows, and bytes of a text that may be in it.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 1 << 14
EPOCHS, MINIBATCH, RATE = 4, 16, 0.5
#: Steps of training that a small table gets as well; with fewer, clean texts are not told from foreign ones.
LEAST_STEPS = 800
#: Share of right predictions on texts kept out of training that the rejection may cost.
REJECTED_RIGHT = 0.002
#: Excerpts per length (4 bytes, doubled up to the text's) of a text, and bytes of them where that is less.
EXCERPTS, EXCERPT_BYTES = 8, 512
#: Texts' classes for the threshold are powers of two of different subwords; one with fewer right predictions takes that of shorter texts.
CLASSES, LEAST_RIGHT = BITS + 1, 30
#: Deviations of a normal variable below which the share REJECTED_RIGHT lies; it stands in where the quantile is less sure.
TAIL = 2.88

_FOLD = np.full(256, 32, np.uint8)
for _c in range(256):
    if 97 <= _c <= 122 or _c >= 128:
        _FOLD[_c] = _c
    elif 65 <= _c <= 90:
        _FOLD[_c] = _c + 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def subwords(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Buckets by byte position and order (positions x 2); 2**BITS where a gram would cross a word or a text."""
    n, none = len(raw), 1 << BITS
    folded = _FOLD[raw]
    wide = np.zeros(n + 4, np.uint32)
    wide[:n] = folded
    blank = np.ones(n + 4, bool)
    blank[:n] = folded == 32
    out = np.empty((n, 2), np.int32)
    code = wide[:n] | wide[1 : n + 1] << np.uint32(8) | wide[2 : n + 2] << np.uint32(16)
    for k, gram in enumerate((code ^ np.uint32(0x51ED270B), code | wide[3 : n + 3] << np.uint32(24))):
        hashed = gram * np.uint32(0x9E3779B1)
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x85EBCA77)
        out[:, k] = hashed >> np.uint32(32 - BITS)
        inner = blank[1 : n + 1] | blank[2 : n + 2] if k else blank[1 : n + 1]
        out[inner, k] = none
    ends = starts[1:]
    for back in range(1, 4):
        at = ends - back
        at = at[at >= starts[:-1]]
        out[at, 1] = none
        if back < 3:
            out[at, 0] = none
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # buckets + 1 by languages; the last row is 0
    bias: np.ndarray
    temperature: float
    thresholds: np.ndarray  # least log odds of a score, by class of the number of different subwords

    def raw_logits(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits by text and language, and the number of different subwords by text."""
        buckets = subwords(raw, starts)
        total = np.zeros((len(starts) - 1, len(self.languages)))
        grams = np.zeros(len(starts) - 1)
        full = np.flatnonzero(starts[1:] > starts[:-1])
        if len(full):
            at = starts[:-1][full]
            for k in range(2):
                total[full] += np.add.reduceat(self.logits[buckets[:, k]], at, axis=0)
                grams[full] += np.add.reduceat((buckets[:, k] < 1 << BITS).astype(np.float64), at)
        return total / np.maximum(grams, 1)[:, None] + self.bias, _different(buckets, starts)

    def scores(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, log odds of the score and class of each text; scores near 1 are told apart by their odds only."""
        z, grams = self.raw_logits(raw, starts)
        z /= self.temperature
        which, top = z.argmax(1), z.max(1, keepdims=True)
        p = np.exp(z - top)
        score = 1 / p.sum(1)
        rest = z.copy()
        rest[np.arange(len(z)), which] = -np.inf
        next_best = rest.max(1, keepdims=True) if z.shape[1] > 1 else top
        with np.errstate(divide="ignore"):
            odds = (top - next_best)[:, 0] - np.log(np.exp(rest - next_best).sum(1))
        return which, score, odds, np.minimum(np.log2(np.maximum(grams, 1)).astype(np.int64), CLASSES - 1)


def _different(buckets: np.ndarray, starts: np.ndarray, step: int = 64) -> np.ndarray:
    """How many different subwords each text has."""
    out = np.zeros(len(starts) - 1, np.int64)
    for first in range(0, len(out), step):
        edges = starts[first : first + step + 1]
        seen = np.zeros((len(edges) - 1, (1 << BITS) + 1), bool)
        of = np.repeat(np.arange(len(edges) - 1) * seen.shape[1], np.diff(edges))
        for k in range(2):
            seen.reshape(-1)[of + buckets[edges[0] : edges[-1], k]] = True
        out[first : first + step] = np.count_nonzero(seen[:, :-1], axis=1)
    return out


def _excerpts(raw: bytes, rng: np.random.Generator) -> list[bytes]:
    """The text, and pieces of it of 4 bytes, 8, 16 and so on."""
    out, size = [raw], 4
    while size < len(raw):
        many = max(1, min(EXCERPTS, EXCERPT_BYTES // size))
        out += [raw[at : at + size] for at in rng.integers(0, len(raw) - size + 1, many).tolist()]
        size *= 2
    return out


def _thresholds(model: LanguageModel, raws: list[bytes], target: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """By class the log odds that all but REJECTED_RIGHT of the right predictions reach; they never fall with length."""
    found, klass = [], []
    for raw, lang in zip(raws, target.tolist(), strict=True):
        cut = _excerpts(raw, rng)
        which, _, own, of = model.scores(np.frombuffer(b"".join(cut), np.uint8), np.cumsum([0, *map(len, cut)]))
        right = which == lang
        found.append(own[right])
        klass.append(of[right])
    odds, classes = np.concatenate(found), np.concatenate(klass)
    out, last = np.full(CLASSES, -np.inf), -np.inf
    if len(model.languages) < 2:
        return out
    for k in range(CLASSES):
        own = odds[classes == k]
        if len(own) >= LEAST_RIGHT:
            low = np.quantile(own, REJECTED_RIGHT)
            if len(own) * REJECTED_RIGHT < 1:
                low = min(low, own.mean() - TAIL * own.std() * (1 + 1 / np.sqrt(len(own))))
            last = float(low)
        out[k] = last
    return np.minimum.accumulate(out[::-1])[::-1]


def train(rows: list[tuple[str, str]], seed: int = 7) -> LanguageModel | None:
    """rows: (text, language). None without rows."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    counts = []
    for text, _ in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, n = np.unique(subwords(raw, np.array([0, len(raw)])), return_counts=True)
        use = ids < 1 << BITS
        counts.append((ids[use], (n[use] / max(1, n[use].sum())).astype(np.float32)))
    target = np.array([languages.index(lang) for _, lang in rows])
    order = rng.permutation(len(rows))
    kept_out, order = order[: len(rows) // 5], order[len(rows) // 5 :]
    e = rng.normal(0, 0.3, (1 << BITS, WIDTH)).astype(np.float32)
    w, b = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps = max(LEAST_STEPS, EPOCHS * len(order) // MINIBATCH)
    for step in range(steps):
        rate = np.float32(RATE * (1 - step / steps))
        own = rng.choice(order, MINIBATCH)
        ids = np.concatenate([counts[i][0] for i in own])
        share = np.concatenate([counts[i][1] for i in own])
        of = np.repeat(np.arange(MINIBATCH), [len(counts[i][0]) for i in own])
        h = np.zeros((MINIBATCH, WIDTH), np.float32)
        np.add.at(h, of, e[ids] * share[:, None])
        z = h @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(MINIBATCH), target[own]] -= 1
        back = p @ w.T
        w -= rate * (h.T @ p) / MINIBATCH * 4
        b -= rate * p.mean(0)
        np.add.at(e, ids, -rate * back[of] * share[:, None] * np.float32(WIDTH))
    table = np.zeros(((1 << BITS) + 1, len(languages)), np.float32)
    learned = np.unique(np.concatenate([counts[i][0] for i in order]))
    table[learned] = e[learned] @ w  # a subword that no training text has says nothing
    model = LanguageModel(languages, table, b.astype(np.float64), 1.0, np.full(CLASSES, -np.inf))
    check = kept_out if len(kept_out) else order
    raws = [rows[i][0].encode() for i in check]
    z, _ = model.raw_logits(np.frombuffer(b"".join(raws), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64))

    def loss(t: float) -> float:
        s = z / t
        return float(np.mean(np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(s)), target[check]]))

    model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
    model.thresholds = _thresholds(model, raws, target[check], rng)
    return model


def fit_languages(docs: DataFrame, where: Column, text_column: str = "text", lang_column: str = "lang", sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id") -> LanguageModel | None:
    """Trains on at most 2 * sample_rows rows that fit where, have a language and at most SAMPLE_BYTES bytes.

    Rows are drawn by a hash of id and text, about sample_rows of them; where repeated rows make them more, the least hashes stay.
    An executor's task trains, so that the driver gets no text.
    """
    rows = docs.select(F.col(text_column).cast("string").alias("t"), F.col(lang_column).cast("string").alias("l"), F.xxhash64(id_column, text_column).alias("h"), where.alias("ok")).where(F.col("ok") & F.col("l").isNotNull() & F.col("t").isNotNull())
    rows = rows.where(F.octet_length("t").between(1, SAMPLE_BYTES))
    n = rows.agg(F.count("t")).first()[0]
    drawn = rows.where(F.pmod("h", F.lit(1 << 20)) < int(min(1.0, sample_rows / max(1, n)) * (1 << 20)) + 1)

    def make(batches: list[pa.RecordBatch]) -> bytes:
        found = sorted((t, lang) for b in batches for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        return pickle.dumps(train(found))

    return pickle.loads(in_one_task(drawn.orderBy("h", "t", "l").limit(2 * sample_rows).select("t", "l"), make)) if n else None


def predict(model: LanguageModel | None, column: pa.Array) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and rejection by text."""
    raw, starts = utf8(column)
    n = len(starts) - 1
    if model is None or not n:
        return [UNKNOWN] * n, [0.0] * n, [True] * n
    which, score, odds, klass = model.scores(raw, starts)
    letter = np.zeros(n, bool)
    has = np.flatnonzero(starts[1:] > starts[:-1])
    if len(has):
        letter[has] = np.add.reduceat(_ASCII_LETTER[raw].astype(np.int64), starts[:-1][has]) > 0
    for i in np.flatnonzero(~letter):
        text = column[int(i)].as_py()
        letter[i] = bool(text) and any(map(str.isalpha, text))
    score = np.where(letter, score, 0.0)
    return [model.languages[w] if ok else UNKNOWN for w, ok in zip(which, letter, strict=True)], score.tolist(), (~letter | (odds < model.thresholds[klass])).tolist()


def identify(docs: DataFrame, model: LanguageModel | None, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns named by keep, then lang_pred, score and rejected."""
    spark = docs.sparkSession
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(model)  # its size is fixed by BITS
    keep = [c for c in keep if c not in ("lang_pred", "score", "rejected")]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 8 << 20):
            lang, score, rejected = predict(shipped.value, batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=schema.names)

    return docs.select(*keep, F.col(text_column).cast("string").alias("_text_of_row")).mapInArrow(run, schema)
