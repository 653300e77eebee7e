"""Suffix deduplication with a run-length index: bytes inside long strings that start more than once are marked.

Every window of MATCH bytes has an anchor, the least hash among its grams, leftmost of equals; equal windows have equal
anchors at equal offsets. Consecutive windows of one anchor form a piece, so pieces part the windows of a text.

1. Grams that are anchors of one piece only cannot belong to a repeated window. The other pieces are kept.
2. A piece that occurs as a whole more than once, by 128 bits of two unlike hashes, is repeated throughout. Of such
   pieces one is kept to match others.
3. Different pieces of one anchor meet in a task, which builds a run-length index over them (see run_length_index):
   matching statistics stream from its samples, and stretches with matches of MATCH bytes or more are marked.
4. An anchor with more than HOT_PIECES different pieces is not gathered, as no bound holds for them. Its windows are taken in
   lots of LOT by their offset from the anchor; lots whose common bytes are unique go, lots that are equal as a whole are
   repeated, and the windows of the others are counted by both hashes.

Texts that a sieve of fixed size shows to have no piece in question, or no mark, are not shuffled.

Defined cases: null and empty texts, and texts shorter than MATCH, lose nothing. Matches do not cross documents.
Repeated rows are copies and lose all from MATCH bytes on. Very long texts are worked through in overlapping
parts. An empty table gives no rows. Only the id and text columns are read, so other columns cannot clash. The input
must be a table, or a plan that gives the same rows in the same order again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import checkpoint, give_back, pieces, sieve, sieve_place, small_batches, utf8
from geoloom.llm.run_length_index import RunLengthIndex

MATCH, GRAM = 200, 48
HOT_PIECES, LOT = 400, 16
#: Tasks among which the different pieces of one anchor are dealt where they are only counted.
SALTS = 8
#: Bytes of text that one index holds, and windows of a text that are worked through at once.
INDEX_BYTES, PART = 2 << 20, 1 << 22
PLACE_BITS = 24

#: Of each of two unlike hashes the base and the values of bytes.
_BASES = (np.uint64(0x9DDFEA08EB382D69), np.uint64(0xA0761D6478BD642F))
_BYTES = [np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1) for seed in (5, 6)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64, at least n of each."""
    if which not in _powers or len(_powers[which][0]) < n:
        size, base = max(n, 1 << 20), _BASES[which]
        _powers[which] = tuple(np.full(size, b) for b in (base, np.uint64(pow(int(base), -1, 1 << 64))))
        for powers in _powers[which]:
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
    return _powers[which]


def _tidy() -> None:
    _powers.clear()  # made anew in milliseconds
    give_back()


def _tidied(work: Callable) -> Callable:
    """The work of a task, after which its worker, which lives on beside others, holds nothing of it."""

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        _tidy()

    return run


class Hashes:
    """Hashes of any substring of some bytes, by prefix sums."""

    def __init__(self, raw: np.ndarray, which: int = 0):
        up, self.down = _powers_of(len(raw) + 1, which)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        values = _BYTES[which][raw]
        values *= up[: len(raw)]
        np.cumsum(values, out=self.sums[1:])

    def of(self, start, end):
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = self.sums[size:] - self.sums[:-size]
        h *= self.down[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each window of width values, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    whole = -(-len(x) // width) * width
    blocks = np.full((whole // width, width), np.iinfo(np.uint64).max)
    blocks.ravel()[: len(x)] = x
    back = np.empty_like(blocks)
    np.minimum.accumulate(blocks[:, ::-1], 1, out=back[:, ::-1])
    least = back.ravel()[:n]
    np.minimum.accumulate(blocks, 1, out=blocks)
    return np.minimum(least, blocks.ravel()[width - 1 : width - 1 + n], out=least)


def cut(raw: np.ndarray, starts: np.ndarray, match: int = MATCH, gram: int = GRAM, brief: bool = False) -> tuple[np.ndarray, ...]:
    """Pieces of texts: text, first window, past the last window (both by place in raw), gram hash and two hashes of the content, or one if brief."""
    none = tuple(np.zeros(0, np.uint64 if k > 2 else np.int64) for k in range(5 if brief else 6))
    if len(raw) < match:
        return none
    hashes = Hashes(raw)
    grams = hashes.grams(gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = grams & ~low
    key |= np.arange(len(grams), dtype=np.uint64)
    least = _sliding_least(key, match - gram + 1)  # of each place where a window would fit
    del key
    valid = np.zeros(len(least) + 1, np.int8)
    many = np.diff(starts) - match + 1
    fit = many > 0
    valid[starts[:-1][fit]] += 1
    valid[(starts[:-1] + many)[fit]] -= 1
    windows = np.flatnonzero(np.cumsum(valid[:-1], dtype=np.int8))
    if not len(windows):
        return none
    anchor = least[windows]
    del least
    anchor &= low
    anchor = anchor.view(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)]))
    first, last = windows[new], windows[np.concatenate([new[1:] - 1, [len(windows) - 1]])] + 1
    text = np.searchsorted(starts, first, "right") - 1
    h, ends = grams[anchor[new]], last - 1 + match
    del grams, windows, anchor, new
    contents = [hashes.of(first, ends)]
    del hashes
    return text, first, last, h, *contents, *([] if brief else [Hashes(raw, 1).of(first, ends)])


def _parts(batches: Iterator[pa.RecordBatch], text_column: int, match: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches with raw bytes, starts, the row of each text and how far into its row it begins; long texts come in overlapping parts."""
    for batch in pieces(batches, PART, tidy=False):
        raw, starts = utf8(batch.column(text_column))
        if len(raw) <= 2 * PART:
            yield batch, raw, starts, np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            continue
        for row in range(batch.num_rows):
            size = int(starts[row + 1] - starts[row])
            for at in range(0, max(1, size - match + 1), PART):
                end = min(size, at + PART + match - 1)
                yield batch, raw[starts[row] + at : starts[row] + end], np.array([0, end - at]), np.array([row]), np.array([at])


def _anchors(match: int, gram: int, brief: bool) -> Callable:
    """From (row, text): the gram hashes with their counts, or all of each piece."""

    @_tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, starts, rows, offset in _parts(batches, 1, match):
            text, first, last, h, content, *rest = cut(raw, starts, match, gram, brief)
            # in a periodic text the same piece follows itself many times: one row tells how often
            new = np.flatnonzero(np.concatenate([[True], (content[1:] != content[:-1]) | (h[1:] != h[:-1]) | (text[1:] != text[:-1]) | (first[1:] != last[:-1])]))[: len(text)]
            times = np.diff(np.concatenate([new, [len(text)]]))
            text, first, last, h, content, *rest = (v[new] for v in (text, first, last, h, content, *rest))
            if brief:
                h, which = np.unique(h, return_inverse=True)
                n = np.bincount(which, times, len(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])
                continue
            own = batch.column(0).to_numpy()[rows[text]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array((first - starts[text] + offset[text]).astype(np.int32)), pa.array((last - first).astype(np.int32)), pa.array(times.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(content.view(np.int64)), pa.array(rest[0].view(np.int64))],
                names=["row", "at", "windows", "times", "h", "content", "content2"],
            )

    return run


def _slices(match: int, gram: int) -> Callable:
    """From (row, text, wanted): the bytes of wanted pieces, and the lots of hot ones."""

    @_tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, PART, tidy=False):
            out: list[tuple] = []
            for row, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = (text or "").encode()
                for w in wanted or ():
                    at, many = w["at"], w["windows"]
                    body = raw[at : at + many + match - 1]
                    if not w["hot"]:
                        out.append((w["h"], row, at, w["single"], body, None, None, None))
                        continue
                    piece = np.frombuffer(body, np.uint8)
                    hashes = Hashes(piece)
                    grams = hashes.grams(gram)[: match - gram + many].view(np.int64)
                    place = int(np.flatnonzero(grams == w["h"])[0])
                    offset = place - np.arange(many)  # of the anchor in each window
                    windows, windows2 = (x.of(np.arange(many), np.arange(many) + match).view(np.int64) for x in (hashes, Hashes(piece, 1)))
                    for lot in np.unique(offset // LOT).tolist():
                        own = np.flatnonzero(offset // LOT == lot)
                        # all windows of a lot, whether the piece has them or not, share the bytes from the last begin to the first end; they lie in the piece
                        core = hashes.of(np.array([place - lot * LOT]), np.array([place - (lot + 1) * LOT + 1 + match]))
                        out.append((int(core.view(np.int64)[0]), row, at + int(own[0]), w["single"], None, lot, windows[own].tolist(), windows2[own].tolist()))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)], names=["h", "row", "at", "single", "body", "lot", "hashes", "hashes2"])

    return run


def _index(match: int) -> Callable:
    """From (h, row, at, single, body) by h: repeated stretches (row, start, end) of the single pieces."""

    def marks(held: list[tuple]) -> list[tuple[int, int, int]]:
        index = RunLengthIndex([r[4] for r in held])
        first, last = index.long_matches(match)
        own = np.searchsorted(index.starts, first, "right") - 1
        shift = np.array([r[2] for r in held], np.int64)[own] - index.starts[own]
        return [(held[k][1], a, b + match) for k, a, b in zip(own.tolist(), (first + shift).tolist(), (last + shift).tolist(), strict=True) if held[k][3]]

    @_tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())], names=["row", "begin", "end"])

        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > INDEX_BYTES and r[0] != held[-1][0]:
                    yield table(marks(held))
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        yield table(marks(held) if held else [])

    return run


@_tidied
def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (row, doc_id, text, marks): the kept text and what was removed."""
    for batch in pieces(batches, PART, tidy=False):
        kept, sizes, removed, spans = [], [], [], []
        for text, marks in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            raw = (text or "").encode()
            merged: list[list[int]] = []
            for m in sorted((m["begin"], m["end"]) for m in marks or ()):
                if merged and m[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], m[1])
                else:
                    merged.append(list(m))
            ends = [0, *(e for _, e in merged)]
            kept.append(b"".join(raw[a:b] for a, b in zip(ends, [*(s for s, _ in merged), len(raw)], strict=True)))
            sizes.append(len(raw))
            removed.append(len(raw) - len(kept[-1]))
            spans.append([{"begin": s, "end": e} for s, e in merged])
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def _untouched(fine) -> Callable:
    """Rows off the places of a sieve, with nothing removed. One function does both, as two would be two workers a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _remove(batch.append_column("marks", pa.nulls(batch.num_rows)) for batch in _sift(fine, False)(batches))

    return run


def _sift(fine, wanted: bool) -> Callable:
    """Rows on or off the places of a sieve, without the place."""

    @_tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = fine.value[batch.column(3).to_numpy()]
            yield batch.filter(pa.array(on if wanted else ~on)).select(["row", "doc_id", "text"])

    return run


def suffix_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", match: int = MATCH, gram: int = GRAM, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs of bytes) and kept (the bytes that stay); one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    narrow = rows.select("row", "text")
    often = narrow.mapInArrow(_anchors(match, gram, True), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    every = narrow.mapInArrow(_anchors(match, gram, False), "row long, at int, windows int, times int, h long, content long, content2 long")
    found = checkpoint(every.join(often, "h"))

    piece = ["h", "content", "content2"]
    same = found.groupBy(*piece).agg(F.sum("times").alias("copies"), F.min(F.struct("row", "at")).alias("one"))
    several = same.groupBy("h").agg(F.count("*").alias("different")).where("different > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    counted_pieces = same.withColumn("salt", F.pmod("content", F.lit(SALTS)).cast("int")).join(several, ["h", "salt"], "left").withColumn("different", F.coalesce("different", F.lit(1))).drop("salt")
    told = found.join(counted_pieces, piece)
    direct = told.where("copies > 1").select("row", F.col("at").alias("begin"), (F.col("at") + F.col("windows") * F.col("times") + (match - 1)).alias("end"))
    wanted = told.where("different > 1 and (copies = 1 or (one.row = row and one.at = at))")
    wanted = wanted.select("row", F.struct("at", "windows", "h", (F.col("copies") == 1).alias("single"), (F.col("different") > hot_pieces).alias("hot")).alias("w"))
    by_row = checkpoint(wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")))
    placed = rows.select("row", "doc_id", "text", sieve_place(F.col("row")).alias("place"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sift = lambda fine: placed.mapInArrow(_sift(fine, True), f"row long, doc_id {kind}, text string")
    sliced = sift(spark.sparkContext.broadcast(sieve(by_row, "row"))).join(by_row, "row").select("row", "text", "wanted").mapInArrow(_slices(match, gram), "h long, row long, at int, single boolean, body binary, lot int, hashes array<long>, hashes2 array<long>")
    sliced = checkpoint(sliced)

    bodies = sliced.where("body is not null").select("h", "row", "at", "single", "body").repartition(parts, "h").sortWithinPartitions("h", "row", "at")
    matched = bodies.mapInArrow(_index(match), "row long, begin int, end int")

    # Lots that are equal as a whole are repeated throughout, as pieces are; windows are made of the others and of one of each kind.
    lots = sliced.where("body is null").select("h", "lot", "row", "at", "single", "hashes", "hashes2", F.struct(F.xxhash64("hashes").alias("a"), F.xxhash64("hashes2").alias("b")).alias("whole"))
    same_lots = lots.groupBy("h", "lot", "whole").agg(F.count("*").alias("copies"), F.min(F.struct("row", "at")).alias("one"))
    kinds = same_lots.groupBy("h", "lot").agg(F.count("*").alias("different"))
    told_lots = lots.join(same_lots.join(kinds, ["h", "lot"]), ["h", "lot", "whole"])
    equal = told_lots.where("copies > 1 and single").select("row", F.col("at").alias("begin"), (F.col("at") + F.size("hashes") + (match - 1)).alias("end"))
    apart = told_lots.where("different > 1 and (copies = 1 or (one.row = row and one.at = at))")
    windows = apart.select("row", "at", (F.col("single") & (F.col("copies") == 1)).alias("single"), F.posexplode(F.arrays_zip("hashes", "hashes2")).alias("k", "window"))
    twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    counted = windows.where("single").join(twice, "window").select("row", (F.col("at") + F.col("k")).alias("begin"), (F.col("at") + F.col("k") + match).cast("int").alias("end"))

    marks = checkpoint(direct.union(matched).union(equal).union(counted).groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("marks")))
    fine = spark.sparkContext.broadcast(sieve(marks, "row"))
    out = f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary"
    touched = sift(fine).join(marks, "row", "left").select("row", "doc_id", "text", "marks").mapInArrow(_remove, out)
    whole = placed.mapInArrow(_untouched(fine), out)
    return touched.union(whole)
