"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become templates: a number, a name (a capitalised word inside a sentence) and a unit
after a number become typed placeholders, every other word is lower-cased. Windows of template tokens are joined by
their hash, documents' with the benchmark's. Matches at consecutive places of one document and one item form an aligned
run, which is as long as the templates agree. A run counts if its slots are consistent: along all of it each value of the
item stands for one value of the document and the reverse, as in a copy or in the same question with other
parameters. A run that contradicts itself counts nothing.

Both sides of the join are distributed. A table of fixed size, which marks where hashes of the benchmark fall, keeps windows
that match nothing out of the shuffle; it decides nothing. The benchmark's windows are repeated SALTS times and the documents'
dealt among them, so that a passage that very many documents have does not meet in one task.

Defined cases: a null or empty text or item matches nothing. An item of fewer tokens than a window is one window,
all of it. With fewer than least_literals plain words other values cannot be told from chance, so only the same values
match. An item's first word is looked for both as a word and as the name or unit that it is after text without an end.
Repeated items and rows are treated alike, one by one. Empty tables are fine on either side. The documents' columns may have
any names; kept ones that are called like a result give way to it. The documents must be a table, or a plan that gives
the same rows in the same order again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import SIEVE_BITS, checkpoint, marked_places, pieces, small_batches, texts

WINDOW, LEAST_LITERALS = 13, 6
#: Copies of the benchmark's windows among which the documents' windows are dealt.
SALTS = 8
#: Tokens whose codes a task remembers.
REMEMBERED = 150_000
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
#: Words that are units when they follow a number.
UNITS = frozenset("mm cm m km mg g kg t ml l s sec second seconds min minute minutes h hour hours day days week weeks month months year years mile miles inch inches foot feet yard yards pound pounds ounce ounces dollar dollars euro euros cent cents percent degree degrees litre litres liter liters meter meters metre metres gram grams hz khz mhz w kw v".split())
RESULTS = ("contaminated", "n_windows", "items")

_TOKEN = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+|[.!?\n]")
_PLAIN, _TITLE, _NUMBER, _END, _UNIT = range(5)
_STEP = np.uint64(0x2545F4914F6CDD1D)


def _code(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little")


_NAME_CODE, _UNIT_CODE = np.uint64(_code(NAME)), np.uint64(_code(UNIT))


class Tokens(dict):
    """Tokens by number, with the code of each in a template, the code of its value and its kind; remembered while there are not too many."""

    def __init__(self):
        super().__init__()
        self._empty(REMEMBERED)

    def _empty(self, size: int) -> None:
        self.clear()
        self.codes, self.values, self.kinds = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.int8)

    def __missing__(self, token: str) -> int:
        k = len(self)
        if k == len(self.codes):
            for name in ("codes", "values", "kinds"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        low = token.lower()
        self.values[k] = _code(low)
        if token[0].isdigit():
            self.codes[k], self.kinds[k] = _code(NUMBER), _NUMBER
        elif token in ".!?\n":
            self.kinds[k] = _END
        else:
            self.codes[k] = self.values[k]
            self.kinds[k] = _UNIT if low in UNITS else _TITLE if token[0].isupper() and token[1:] == low[1:] else _PLAIN
        self[token] = k
        return k

    def templates(self, column: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts one after the other: template codes, slots, value codes and kinds by token, and where each text starts."""
        if len(self) > REMEMBERED:
            self._empty(REMEMBERED)
        found = [list(map(self.__getitem__, _TOKEN.findall(text))) for text in column]
        sizes = np.array([len(f) for f in found], np.int64)
        ids = np.concatenate([np.array(f, np.int64) for f in found]) if found else np.zeros(0, np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        codes, values, kinds = self.codes[ids], self.values[ids], self.kinds[ids]
        before = np.concatenate([[_END], kinds[:-1]])[: len(kinds)]
        before[starts[:-1][sizes > 0]] = _END
        name = (kinds == _TITLE) & (before != _END)
        unit = (kinds == _UNIT) & (before == _NUMBER)
        codes[name], codes[unit] = _NAME_CODE, _UNIT_CODE
        use = kinds != _END
        kept = np.concatenate([[0], np.cumsum(use)])[starts]
        return codes[use], (name | unit | (kinds == _NUMBER))[use], values[use], kinds[use], kept


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(size))
    for k in range(size):
        total = total * _STEP + (codes[k : k + n] ^ (codes[k : k + n] >> np.uint64(29)))
    return total ^ (total >> np.uint64(32))


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def _slot_values(slots: np.ndarray, values: np.ndarray, at: np.ndarray, size: int) -> pa.Array:
    """The value codes in the slots of the windows at these tokens, as lists."""
    where = np.flatnonzero(slots)
    low, high = np.searchsorted(where, at), np.searchsorted(where, at + size)
    many = high - low
    ends = np.concatenate([[0], np.cumsum(many)])
    flat = np.repeat(low - ends[:-1], many) + np.arange(ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values[where[flat]].view(np.int64)))


BENCHMARK = "hash long, size int, item long, item_id long, start int, enough boolean, own array<long>"


def _benchmark_windows(window: int, least_literals: int) -> Callable:
    """From (item, item_id, text): every window, and the first one again with its first word as a slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in pieces(batches, 1 << 20):
            for item, item_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes, slots, values, kinds, _ = tokens.templates([text or ""])
                size = min(window, len(codes))
                if not size:
                    continue
                other = {_TITLE: _NAME_CODE, _UNIT: _UNIT_CODE}.get(int(kinds[0])) if not slots[0] else None
                variants = [(codes, slots, len(codes) - size + 1)]
                if other is not None:
                    variants.append((np.concatenate([[other], codes[1:size]]), np.concatenate([[True], slots[1:size]]), 1))
                for own_codes, own_slots, many in variants:
                    literal = np.concatenate([[0], np.cumsum(~own_slots)])
                    at = np.arange(many)
                    enough = literal[at + size] - literal[at] >= least_literals
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(window_hashes(own_codes, size).view(np.int64)), pa.array(np.full(many, size, np.int32)), pa.array(np.full(many, item)), pa.array([item_id] * many, pa.int64()), pa.array(at.astype(np.int32)), pa.array(enough), _slot_values(own_slots, values, at, size)],
                        names=["hash", "size", "item", "item_id", "start", "enough", "own"],
                    )

    return run


def _document_windows(sizes: list[int], table) -> Callable:
    """From (row, text): the windows whose hash falls where one of the benchmark's does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, fine = Tokens(), table.value
        for batch in pieces(batches, 2 << 20):
            codes, slots, values, _, starts = tokens.templates(texts(batch.column(1)))
            rows = batch.column(0).to_numpy()
            for size in sizes:
                hashes = window_hashes(codes, size)
                at = np.flatnonzero(fine[_place(hashes)])
                text = np.searchsorted(starts, at, "right") - 1
                inside = at + size <= starts[text + 1]
                at, text = at[inside], text[inside]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at].view(np.int64)), pa.array(np.full(len(at), size, np.int32)), pa.array(rows[text]), pa.array((at - starts[text]).astype(np.int32)), _slot_values(slots, values, at, size)],
                    names=["hash", "size", "row", "at", "values"],
                )

    return run


def consistent(pairs: set[tuple[int, int]]) -> bool:
    """Whether the values of an item and of a document stand for each other one to one."""
    return len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (row, item, size, diagonal, at, item_id, enough, own, values) in this order: (row, item_id, n) of runs that count."""

    def count(run: list[tuple]) -> int:
        alike = [own == values for *_, own, values in run]
        if not all(alike) and not consistent({pair for *_, own, values in run for pair in zip(own, values, strict=True)}):
            return 0
        return sum(same or r[6] for same, r in zip(alike, run, strict=True))

    held: list[tuple] = []
    for batch in batches:
        out: list[tuple] = []
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (held[-1][:4] != r[:4] or held[-1][4] + 1 != r[4]):
                out.append((held[0][0], held[0][5], count(held)))
                held = []
            held.append(r)
        yield _counts(out)
    yield _counts([(held[0][0], held[0][5], count(held))] if held else [])


def _counts(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r for r in rows if r[2]]
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], names=["row", "item_id", "n"])


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_literals: int = LEAST_LITERALS, text_column: str = "text") -> DataFrame:
    """(row_id, n_windows, items) of documents in which an item is found. row_id is a row's place in docs, items are sorted benchmark ids."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    wanted = checkpoint(items.mapInArrow(_benchmark_windows(window, least_literals), BENCHMARK))
    sizes = sorted(r["size"] for r in wanted.select("size").distinct().collect())  # at most window sizes
    fine = spark.sparkContext.broadcast(marked_places(wanted.select(F.shiftrightunsigned("hash", 64 - SIEVE_BITS).alias("p"))))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_column).cast("string").alias("text"))
    found = rows.mapInArrow(_document_windows(sizes, fine), "hash long, size int, row long, at int, values array<long>").withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    salted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = found.join(salted, ["hash", "size", "salt"]).select("row", "item", "size", (F.col("at") - F.col("start")).alias("diagonal"), "at", "item_id", "enough", "own", "values")
    ordered = met.repartition(parts, "row").sortWithinPartitions("row", "item", "size", "diagonal", "at")
    judged = ordered.mapInArrow(_judge, "row long, item_id long, n long")
    return judged.groupBy(F.col("row").alias("row_id")).agg(F.sum("n").alias("n_windows"), F.array_sort(F.collect_set("item_id")).alias("items"))


def mark(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, least_literals: int = LEAST_LITERALS, text_column: str = "text") -> DataFrame:
    """The columns named by keep, then contaminated, n_windows and items (sorted benchmark ids)."""
    found = contaminated_rows(docs, benchmark, window, least_literals, text_column).select("row_id", F.struct("n_windows", "items").alias("found"))
    keep = [c for c in keep if c not in RESULTS]
    rows = docs.select(F.struct(*keep).alias("kept") if keep else F.lit(True).alias("kept"), F.monotonically_increasing_id().alias("row_id"))
    out = rows.join(found, "row_id", "left")
    none = F.array().cast("array<bigint>")
    return out.select(*(F.col("kept").getField(c).alias(c) for c in keep), F.col("found").isNotNull().alias("contaminated"), F.coalesce("found.n_windows", F.lit(0).cast("long")).alias("n_windows"), F.coalesce("found.items", none).alias("items"))
