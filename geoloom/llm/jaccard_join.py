"""N-gram Jaccard join through count vectors and R-trees.

A document is the set of its distinct word shingles, as 64-bit hashes. Documents with equal sets are one class, which the
join takes once. The join is exact:

1. Two sets whose Jaccard similarity reaches the threshold share a shingle among the first ones of each in any
   order common to all (prefix filter). The order puts shingles that are frequent in a bounded sample last; the
   sample decides speed only. Classes that share a prefix shingle get into one block, that of the least such class.
   Two classes may be in several blocks together; only the least of these compares them.
2. In a block the shingles of each class are hashed into groups, and the group counts are a point. R-trees over points of
   an equal number of groups bound the overlap by summed coordinate minima. Classes without a candidate leave the block.
3. For the others the trees are built again beside their sets, and each pair that they yield is verified with the
   sets. A task keeps of the links how many each class has, and a spanning forest; connected components then join the blocks.

A block larger than BLOCK_ROWS or BLOCK_SHINGLES is cut into nodes: by size, in steps as wide as sizes of linked sets can
differ, and where that is not enough by hash. Only nodes of equal or neighbouring steps meet, each two in one task, so no link is
lost and no task holds a large block. Every link is verified to be counted: in a block where all are linked with all, the work
grows with the number of links and a class is copied once for every BLOCK_ROWS classes of its step and the next ones.

Defined cases: null, empty and blank texts have no shingle and link with nothing; with fewer words than a
shingle the whole sequence is the one shingle. A null id is linked with nothing and has a null component. Repeated
rows are copies. An empty table gives no rows. Only the id and text columns are read, so other columns cannot clash. The
input must be a table, or a plan that gives the same rows in the same order again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import checkpoint, mix64, pieces, sieve, sieve_place, small_batches, utf8
from geoloom.llm.components import components

WORDS, PERCENT = 5, 80
#: Documents of a block, and shingles of them all together.
BLOCK_ROWS, BLOCK_SHINGLES = 1000, 2_000_000
#: Documents of the sample behind the order, in how many of them a shingle is frequent, and how many such hashes are broadcast.
SAMPLE_ROWS, FREQUENT, FREQUENT_HASHES = 8000, 4, 1 << 18
FAN_OUT = 16
#: Coordinates that are compared at a time.
COMPARED = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_BYTE, _WORD = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xD6E8FEB86659FD93)


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts, A-Z lower-cased, and how many words each text has."""
    low, blank = _LOWER[raw], _BLANK[raw]
    new = np.zeros(len(raw) + 1, bool)
    new[starts] = True
    first = np.flatnonzero(~blank & (new[:-1] | np.concatenate([[True], blank[:-1]])))
    edge = np.concatenate([blank, [True]]) | new
    edge[0] = False
    last = np.flatnonzero(edge & ~np.concatenate([[True], blank]))  # one past a word
    size = last - first
    order = np.argsort(-size, kind="stable")
    at, length = first[order], size[order]
    h = length.astype(np.uint64) * _WORD
    active = len(order)
    for k in range(int(length[0]) if active else 0):
        while active and length[active - 1] <= k:
            active = int(np.searchsorted(-length, -k, side="left"))
        h[:active] = (h[:active] ^ low[at[:active] + k]) * _BYTE
        h[:active] ^= h[:active] >> np.uint64(29)
    out = np.empty_like(h)
    out[order] = mix64(h)
    return out, np.diff(np.searchsorted(first, starts))


def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, starts = utf8(column)
    hashes, counts = word_hashes(raw, starts)
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    for k in range(min(words, n)):
        total[: n - k] = (total[: n - k] ^ hashes[k:]) * _WORD + np.uint64(k + 1)
        total ^= total >> np.uint64(32)
    total = mix64(total)
    out, at = [], 0
    for count in counts.tolist():
        if count >= words:
            out.append(np.unique(total[at : at + count - words + 1]))
        elif count:
            short = np.uint64(count)
            with np.errstate(over="ignore"):
                for h in hashes[at : at + count]:
                    short = (short ^ h) * _BYTE + np.uint64(1)
            out.append(mix64(np.array([short])))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out


def signature(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def least_overlap(a, b, percent: int = PERCENT):
    """The least intersection of sets of sizes a and b that are linked."""
    return -(-percent * (a + b) // (100 + percent))


# Count vectors


def count_vector(shingles: np.ndarray) -> bytes:
    """Shingles by group, a power of two of groups, at least half as many as shingles; the group is the hash's first bits."""
    bits = max(4, int(len(shingles) - 1).bit_length() - 1)
    counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    """Fewer groups, each the sum of neighbours."""
    return vector.reshape(groups, -1).sum(1, dtype=np.int32)


class RTree:
    """Points with equally many groups. Nodes keep coordinate maxima and sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int = PERCENT):
        self.percent = percent
        self.order = np.lexsort((*points[:, :4].T, sizes))  # packed by size, then by the first coordinates
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FAN_OUT:
            most, least, largest = self.levels[-1]
            at = np.arange(0, len(least), FAN_OUT)
            self.levels.append((np.maximum.reduceat(most, at), np.minimum.reduceat(least, at), np.maximum.reduceat(largest, at)))

    def _fits(self, level: int, nodes: np.ndarray, points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """By query and node, whether the bound on the overlap with what is below reaches what a link needs."""
        most, least, largest = self.levels[level]
        step = max(1, COMPARED // max(1, points.size))
        bound = np.concatenate([np.minimum(points[:, None, :], most[nodes[at : at + step]][None]).sum(2, dtype=np.int64) for at in range(0, len(nodes), step)], axis=1)
        low, high, own = least[nodes][None], largest[nodes][None], sizes[:, None]
        return (bound >= least_overlap(own, low, self.percent)) & (100 * high >= self.percent * own) & (100 * own >= self.percent * low)

    def search(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) that may be linked. Queries of like size keep the search narrow."""
        nodes = np.arange(len(self.levels[-1][1]))
        for level in range(len(self.levels) - 1, -1, -1):
            if not len(nodes):
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            fits = self._fits(level, nodes, points, sizes)
            if not level:
                query, node = np.nonzero(fits)
                return query, self.order[nodes[node]]
            nodes = (nodes[fits.any(0)][:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
            nodes = nodes[nodes < len(self.levels[level - 1][1])]
        raise AssertionError("a tree has a level")


def candidates(vectors: list[np.ndarray], sizes: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of count vectors that may be linked, each once: a tree for each number of groups, which points of as many groups
    and of more, added up to as many, ask."""
    groups = np.array([len(v) for v in vectors], np.int64)
    for g in np.unique(groups).tolist():
        own = np.flatnonzero(groups == g)
        tree = RTree(_narrow(np.stack([vectors[i] for i in own])), sizes[own], percent)
        asking = np.flatnonzero((groups >= g) & (percent * sizes <= 100 * sizes[own].max()))
        asking = asking[np.argsort(sizes[asking], kind="stable")]
        for at in range(0, len(asking), FAN_OUT):
            batch = asking[at : at + FAN_OUT]
            query, point = tree.search(_narrow(np.stack([folded(vectors[i], g) for i in batch])), sizes[batch])
            i, j = batch[query], own[point]
            once = (groups[i] > g) | (i < j)
            if once.any():
                yield i[once], j[once]


def _narrow(points: np.ndarray) -> np.ndarray:
    return points.astype(np.uint8 if points.max(initial=0) < 256 else np.int32)


class Earlier:
    """Which rows have an earlier block in common."""

    def __init__(self, blocks: list[list[int]]):
        names = {p: k for k, p in enumerate(sorted({p for own in blocks for p in own}))}
        self.words = np.zeros((len(blocks), -(-len(names) // 64)), np.uint64)
        for row, own in enumerate(blocks):
            for p in own:
                self.words[row, names[p] // 64] |= np.uint64(1 << names[p] % 64)

    def none(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out, width = np.ones(len(i), bool), self.words.shape[1]
        step = max(1, COMPARED // max(1, width))
        for at in range(0, len(i) if width else 0, step):
            out[at : at + step] = ~(self.words[i[at : at + step]] & self.words[j[at : at + step]]).any(1)
        return out


# Tasks


def _sketch(frequent: np.ndarray, words: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in pieces(batches, 4 << 20):
            sizes, signs, firsts, lasts, vectors = [], [], [], [], []
            named = batch.column(0).is_valid().to_pylist()
            for ok, shingles in zip(named, shingle_sets(batch.column(1), words), strict=True):
                n, sign = len(shingles), signature(shingles)
                sizes.append(n)
                signs.append(sign if ok else None)
                if not n or not ok or sign in seen:
                    firsts.append(None)
                    lasts.append(None)
                    vectors.append(None)
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(sign)
                need = n + percent * n // -100 + 1  # n - ceil(percent * n / 100) + 1
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
                    often = frequent[at] == shingles
                    cold = shingles[~often][:need]
                    hot = shingles[often][: need - len(cold)]
                else:
                    cold, hot = shingles[:need], shingles[:0]
                firsts.append(cold.view(np.int64))
                lasts.append(hot.view(np.int64))
                vectors.append(count_vector(shingles))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int32()), pa.array(signs, pa.binary()), pa.array(firsts, pa.list_(pa.int64())), pa.array(lasts, pa.list_(pa.int64())), pa.array(vectors, pa.binary())],
                names=["doc_id", "row", "n", "sign", "cold", "hot", "vector"],
            )

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, row) in order: the first row of a key with each of its others."""
    key, pivot = None, 0
    for batch in batches:
        keys, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        new = np.concatenate([[key is None or keys[0] != key], keys[1:] != keys[:-1]])
        pivots = rows[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
        if not new[0]:
            own = int(new.argmax()) if new.any() else len(new)
            pivots[:own] = pivot
        key, pivot = keys[-1], pivots[-1]
        keep = pivots != rows
        pairs = np.unique(np.stack([pivots[keep], rows[keep]], 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["p", "x"])


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Rows with equal first columns, which come together."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:key] != row[:key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _own_pairs(pairs: Iterator[tuple[np.ndarray, np.ndarray]], rows: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of pairs of rows (p, g, x, side, cross, ..., earlier at -2) those that this task compares: of both nodes, where two meet, and in no earlier block."""
    side, cross = np.array([r[3] for r in rows]), bool(rows[0][4])
    earlier = Earlier([r[-2] for r in rows])
    for i, j in pairs:
        if cross:
            apart = side[i] != side[j]
            i, j = i[apart], j[apart]
        first = earlier.none(i, j)
        if first.any():
            yield i[first], j[first]


GROUP = ("p", "g", "x", "side", "cross")


def _prune(percent: int) -> Callable:
    """From (p, g, x, side, cross, n, blocks, vector) by p and g: the rows with a candidate, with the blocks before p."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _groups(batches, 2):
            if len(rows) > 1:
                rows = [(*r[:6], [b for b in r[6] if b < r[0]], r[7]) for r in rows]
                fits = np.zeros(len(rows), bool)
                found = candidates([np.frombuffer(r[-1], np.uint8) for r in rows], np.array([r[5] for r in rows], np.int64), percent)
                open_ones = ((i[~(fits[i] & fits[j])], j[~(fits[i] & fits[j])]) for i, j in found)
                for i, j in _own_pairs(open_ones, rows):
                    fits[i] = fits[j] = True
                out += [(*r[:5], r[6]) for r, ok in zip(rows, fits.tolist(), strict=True) if ok]
            if len(out) > 10_000:
                yield _kept(out)
                out = []
        yield _kept(out)

    return run


def _kept(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names=[*GROUP, "earlier"])


class Sets:
    """Sets of a task by number, with their overlaps."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        values, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(values), bool)

    def overlaps(self, i: int, others: np.ndarray) -> np.ndarray:
        own = self.flat[self.ends[i] : self.ends[i + 1]]
        self.mark[own] = True
        many = self.sizes[others]
        first = np.concatenate([[0], np.cumsum(many)[:-1]])
        out = np.add.reduceat(self.mark[self.flat[np.repeat(self.ends[others] - first, many) + np.arange(many.sum())]], first, dtype=np.int64)
        self.mark[own] = False
        return out


def links(rows: list[tuple], percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """From rows (p, g, x, side, cross, copies, earlier, set): (least x that is reached here, x, documents linked with one of x) of those with a link."""
    sets = [np.frombuffer(r[-1], np.uint64) for r in rows]
    held, copies = Sets(sets), np.array([r[5] for r in rows], np.int64)
    label, degree = np.argsort(np.argsort([r[2] for r in rows])), np.zeros(len(rows), np.int64)
    found = candidates([np.frombuffer(count_vector(s), np.uint8) for s in sets], held.sizes, percent)
    for i, j in _own_pairs(found, rows):
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        new = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
        for k, others in zip(i[new].tolist(), np.split(j, new[1:]), strict=True):
            others = others[held.overlaps(k, others) >= least_overlap(held.sizes[k], held.sizes[others], percent)]
            if len(others):
                degree[k] += copies[others].sum()
                degree[others] += copies[k]
                marks = np.unique(np.append(label[others], label[k]))
                if len(marks) > 1:
                    label[np.isin(label, marks[1:])] = marks[0]
    names = sorted(r[2] for r in rows)
    return [(names[label[k]], rows[k][2], int(degree[k])) for k in np.flatnonzero(degree).tolist()]


def _verify(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, 2):
            rows = list({r[2]: r for r in rows}.values())  # a row that the table repeats
            found = links(rows, percent) if len(rows) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], pa.int64()) for j in range(3)], names=["a", "b", "links"])

    return run


def _sets(fine: np.ndarray, words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4 << 20):
            batch = batch.filter(pa.array(fine[batch.column(2).to_numpy()]))
            if not batch.num_rows:
                continue
            sets = shingle_sets(batch.column(1), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(signature, sets)), pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["doc_id", "sign", "set"])

    return run


def frequent_shingles(docs: DataFrame, words: int = WORDS, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Hashes in FREQUENT documents or more of a sample drawn by the hash of id and text, the FREQUENT_HASHES most frequent ones; sorted."""
    n = docs.count()
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(min(1.0, sample_rows / max(1, n)) * (1 << 20)) + 1).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*shingle_sets(batch.column(0), words), np.zeros(0, np.uint64)]).view(np.int64))], names=["s"])

    often = chosen.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= FREQUENT)
    most = often.orderBy(F.desc("count"), "s").limit(FREQUENT_HASHES).select("s")
    return np.sort(most.toArrow().column("s").to_numpy().astype(np.int64).view(np.uint64))


def _spread(blocks: DataFrame, lengths: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """(p, g, x, side, cross) of blocks (p, x): a small block is one group; of a large one each two nodes that may be linked are a group."""
    step = math.log(max(100 / percent, 1.0001) * (1 + 1e-9))
    members = checkpoint(blocks.join(lengths, "x").withColumn("k", F.floor(F.log("n") / step).cast("int")))
    parts = F.ceil(F.greatest(F.count("*") / F.lit(block_rows), F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int")
    large = members.groupBy("p").agg(parts.alias("m")).where("m > 1").select("p")
    small = members.join(large, "p", "left_anti").select("p", F.lit("").alias("g"), "x", F.lit(0).alias("side"), F.lit(False).alias("cross"))
    nodes = members.join(large, "p", "left_semi").groupBy("p", "k").agg(parts.alias("m"))
    for name, to in (("up", -1), ("down", 1)):
        nodes = nodes.join(nodes.select("p", (F.col("k") + to).alias("k"), F.col("m").alias(name)), ["p", "k"], "left")
    cut = members.join(nodes, ["p", "k"]).withColumn("lot", F.pmod(F.xxhash64("x"), F.col("m")).cast("int"))
    group = "struct(concat_ws('.', {0}, {1}, {2}, {3}) as g, {4} as side, {5} as cross)"
    same = group.format("k", "least(lot, j)", "k", "greatest(lot, j)", "if(lot <= j, 0, 1)", "lot <> j")
    above, below = group.format("k", "lot", "k + 1", "j", "0", "true"), group.format("k - 1", "j", "k", "lot", "1", "true")
    several = lambda n, what: f"if({n} is null, array(), transform(sequence(0, {n} - 1), j -> {what}))"
    kind = "array<struct<g:string,side:int,cross:boolean>>"
    met = cut.select("p", "x", F.explode(F.expr(f"concat({several('m', same)}, cast({several('up', above)} as {kind}), cast({several('down', below)} as {kind}))")).alias("to"))
    return small.union(met.select("p", "to.g", "x", "to.side", "to.cross"))


def jaccard_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT, block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least id reachable by links), n_links (documents that it is linked with) and row_id."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    often = spark.sparkContext.broadcast(frequent_shingles(docs, words, sample_rows))  # at most FREQUENT_HASHES
    sketch = lambda batches: _sketch(often.value, words, percent)(batches)
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    known = checkpoint(rows.mapInArrow(sketch, "doc_id long, row long, n int, sign binary, cold array<long>, hot array<long>, vector binary"))
    often.destroy()
    first = known.where("vector is not null")  # of each class at least one row, the least of which stands for it
    classes = checkpoint(known.where("sign is not null").groupBy("sign").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.min(F.when(F.col("vector").isNotNull(), F.col("row"))).alias("x")))

    # Blocks: frequent keys by aggregate and join, which Spark can split; the others by one sorted pass.
    keys = known.select(F.explode("cold").alias("s"), "row").repartition(parts, "s").sortWithinPartitions("s", "row")
    stars = keys.mapInArrow(_stars, "p long, x long")
    hot = known.select(F.explode("hot").alias("s"), "row")
    pivots = hot.groupBy("s").agg(F.min("row").alias("p"), F.count("*").alias("f")).where("f > 1").select("s", "p")
    stars = stars.union(hot.join(pivots, "s").where("row <> p").select("p", F.col("row").alias("x")))
    others = first.select("sign", "row").join(classes, "sign").where("row <> x").select(F.col("row").alias("x"), F.col("x").alias("of"))
    pairs = stars.distinct().join(others, "x", "left").select("p", F.coalesce("of", "x").alias("x")).where("p <> x")
    pairs = checkpoint(pairs.distinct())  # a block's least row stands for its own class
    blocks = pairs.union(pairs.select("p", F.col("p").alias("x")).distinct())
    lengths = first.select(F.col("row").alias("x"), F.col("n").cast("long").alias("n"))
    points = first.select(F.col("row").alias("x"), F.col("n").cast("long").alias("n"), "vector").join(blocks.groupBy("x").agg(F.collect_list("p").alias("blocks")), "x")
    groups = _spread(blocks, lengths, percent, block_rows).join(points, "x").select(*GROUP, "n", "blocks", "vector")
    kept = checkpoint(groups.repartition(parts, "p", "g").sortWithinPartitions("p", "g", "x").mapInArrow(_prune(percent), "p long, g string, x long, side int, cross boolean, earlier array<long>"))

    # Sets of what survives. The sieve only spares work: two documents in one place of it are told apart by the join.
    survivors = first.select("row", "doc_id").join(classes, F.col("row") == F.col("x")).select("x", "doc_id", "sign", "copies").join(kept.select("x").distinct(), "x")
    survivors = checkpoint(survivors)
    fine = spark.sparkContext.broadcast(sieve(survivors, "doc_id"))
    remake = lambda batches: _sets(fine.value, words)(batches)
    made = docs.where("doc_id is not null").select("doc_id", "text", sieve_place(F.col("doc_id")).alias("place")).mapInArrow(remake, "doc_id long, sign binary, set binary")
    wanted = kept.join(survivors, "x").select(*GROUP, "copies", "earlier", "doc_id", "sign")
    sets = wanted.join(made, ["doc_id", "sign"]).select(*GROUP, "copies", "earlier", "set").repartition(parts, "p", "g").sortWithinPartitions("p", "g", "x")
    edges = checkpoint(sets.mapInArrow(_verify(percent), "a long, b long, links long"))
    fine.destroy()
    labels = checkpoint(components(edges.select("a", "b")))
    degrees = edges.groupBy(F.col("b").alias("x")).agg(F.sum("links").alias("links"))

    # Back to documents, by the set.
    linked = classes.join(labels.withColumnRenamed("node", "x"), "x")
    whole = linked.groupBy("label").agg(F.min("least").alias("component"))
    joined = linked.join(whole, "label").join(degrees, "x").select("sign", "component", (F.col("links") + F.col("copies") - 1).alias("links"))
    joined = joined.union(classes.join(labels, F.col("x") == F.col("node"), "left_anti").select("sign", "least", F.col("copies") - 1))
    joined = joined.withColumnRenamed("sign", "_sign")
    out = known.select("doc_id", "n", "sign", "row").join(joined, F.col("sign") == F.col("_sign"), "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), F.col("row").alias("row_id"))
