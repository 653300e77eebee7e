"""Byte-pair encoding through a minimal acyclic lexicon.

The most frequent words of the corpus, counted over all of it, are encoded once and compiled into a minimal
acyclic automaton with shared suffixes. Each arc carries how many words come before those behind it, so that a
walk gives a word's rank, and the rank its ids. The automaton is one file, shipped by Spark to each executor and
memory-mapped there. Words that it lacks are merged exactly, by rank and then by place.

The tokenizer file is read, never changed: NFC, lower case by character, words by pattern, bytes as printable
characters, `</w>` at a word's end, and decoding as the vocabulary's strings joined by one blank.

Defined cases: null and empty texts have no ids and decode to the empty text. The special tokens' strings in a
text become their ids. Very long words are merged in n log n. Repeated rows are treated alike, one by one, an
empty table gives no rows, and only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import json
import mmap
import struct
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import checkpoint, fresh_dir, in_one_task, pieces, small_batches, texts

#: Words that the lexicon holds, and the bytes of the longest.
LEXICON_WORDS, WORD_BYTES = 65_536, 48
#: Distinct words that a task counts before it hands them on, and chunks whose ids a worker remembers.
COUNTED, REMEMBERED, REMEMBERED_LENGTH = 300_000, 250_000, 64
#: Symbols up to which a word is merged by search of the least rank.
SHORT = 40
BITS = 20
MASK, NEVER = (1 << BITS) - 1, 1 << 62

_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0  -     　\p{L}\p{N}]+")
#: Blank for str.split, but not for the tokenizer.
_ODD_BLANKS = regex.compile("[\x1c-\x1f]")


def printable_bytes() -> list[str]:
    """The character that stands for each byte: itself if it is visible in Latin-1, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class Tokenizer:
    """The merges, vocabulary and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # a pair's ids in one number, to its rank and the id it becomes in one number
        self.merges = {self.vocabulary[a] << BITS | self.vocabulary[b]: rank << BITS | self.vocabulary[a + b] for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings = [""] * (max([*self.vocabulary.values(), *self.special.values()]) + 1)
        for s, i in chain(self.vocabulary.items(), self.special.items()):
            self.strings[i] = s
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.byte_ids = [self.vocabulary[c] for c in printable_bytes()]
        self.end_ids = [self.vocabulary[c + self.end] for c in printable_bytes()]

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # Python alone has a final sigma
        return _WORDS.findall(text.lower())

    def merge(self, word: str) -> tuple[int, ...]:
        """The pair of lowest rank is merged first, of equal pairs the leftmost."""
        raw = word.encode()
        ids = [*map(self.byte_ids.__getitem__, raw[:-1]), self.end_ids[raw[-1]]]
        return self._merge_long(ids) if len(ids) > SHORT else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> tuple[int, ...]:
        get = self.merges.get
        ranks = [get(a << BITS | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            ids[i] = merged = best & MASK
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(merged << BITS | ids[i + 1], NEVER)
            if i:
                ranks[i - 1] = get(ids[i - 1] << BITS | merged, NEVER)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        get, n = self.merges.get, len(ids)
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        heap = [(m, i) for i in range(n - 1) if (m := get(ids[i] << BITS | ids[i + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or get(ids[i] << BITS | ids[j], NEVER) != m:
                continue
            merged = m & MASK
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if (k := after[i]) >= 0:
                before[k] = i
                if (m := get(merged << BITS | ids[k], NEVER)) != NEVER:
                    heapq.heappush(heap, (m, i))
            if (k := before[i]) >= 0 and (m := get(ids[k] << BITS | merged, NEVER)) != NEVER:
                heapq.heappush(heap, (m, k))
        return tuple(i for i in ids if i >= 0)

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def compile_lexicon(entries: dict[str, tuple[int, ...]]) -> bytes:
    """A minimal acyclic automaton over UTF-8, built from sorted words, with the ids by rank behind it."""
    words = sorted((w.encode(), ids) for w, ids in entries.items())
    registry: dict[tuple, int] = {}
    nodes: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []  # final, arcs, words from here

    def settle(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in registry:
            registry[key] = len(nodes)
            nodes.append((final, key[1], int(final) + sum(nodes[t][2] for _, t in arcs)))
        return registry[key]

    path: list[list] = [[False, []]]  # open nodes along the last word
    last = b""
    for word, _ in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        for depth in range(len(last), common, -1):
            final, arcs = path.pop()
            path[-1][1].append((last[depth - 1], settle(final, arcs)))
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        final, arcs = path.pop()
        path[-1][1].append((last[depth - 1], settle(final, arcs)))
    root = settle(*path[0])
    first, labels, targets, skips = array("i", [0]), bytearray(), array("i"), array("i")
    finals = bytearray()
    for final, arcs, _ in nodes:
        seen = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skips.append(seen)
            seen += nodes[target][2]
        finals.append(final)
        first.append(len(labels))
    ids = array("i", chain.from_iterable(i for _, i in words))
    at = array("i", [0, *np.cumsum([len(i) for _, i in words]).tolist()] if words else [0])
    blocks = [first.tobytes(), targets.tobytes(), skips.tobytes(), at.tobytes(), ids.tobytes(), bytes(labels), bytes(finals)]
    return struct.pack("<8i", root, *map(len, blocks)) + b"".join(blocks)


class Lexicon:
    """A compiled lexicon, memory-mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, *sizes = struct.unpack_from("<8i", self.map)
        at = [32, *(32 + np.cumsum(sizes)).tolist()]
        view = memoryview(self.map)
        self.first, self.targets, self.skips, self.at = (view[at[k] : at[k + 1]].cast("i") for k in range(4))
        self.ids_at, self.label_at, self.final_at = at[4], at[5], at[6]

    def lookup(self, word: bytes) -> bytes | None:
        """The ids as 32-bit numbers, as they stand in the file."""
        node, rank, labels = self.root, 0, self.label_at
        for byte in word:
            low = self.first[node]
            arc = self.map.find(byte.to_bytes(), labels + low, labels + self.first[node + 1]) - labels
            if arc < low:
                return None
            rank += self.skips[arc]
            node = self.targets[arc]
        if not self.map[self.final_at + node]:
            return None
        return self.map[self.ids_at + 4 * self.at[rank] : self.ids_at + 4 * self.at[rank + 1]]


class _Bounded(dict):
    """What a function gave, remembered for keys of bounded length: the last REMEMBERED new ones and as many before them."""

    def __init__(self, function: Callable[[str], bytes]):
        super().__init__()
        self.function, self.before = function, {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.function(key)
            if len(key) > REMEMBERED_LENGTH:
                return found
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Ids of texts: chunks and words remembered, then words from the lexicon, then exact merges."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon | None):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        self.words = _Bounded(self._word)
        self.chunks = _Bounded(self._chunk)  # a chunk is text without a blank; no word crosses a blank

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        found = self.lexicon.lookup(raw) if self.lexicon and len(raw) <= WORD_BYTES else None
        return found if found is not None else array("i", self.tokenizer.merge(word)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        words = self.tokenizer.words(chunk)
        return self.words[words[0]] if len(words) == 1 else b"".join(map(self.words.__getitem__, words))

    def encode_bytes(self, text: str) -> bytes:
        """The ids as 32-bit numbers of this machine."""
        if not ("<" in text and self.tokenizer.split_special.search(text)) and not _ODD_BLANKS.search(text):
            return b"".join(map(self.chunks.__getitem__, text.split()))
        out = []
        for k, part in enumerate(self.tokenizer.split_special.split(text)):
            if k % 2:
                out.append(array("i", [self.tokenizer.special[part]]).tobytes())
            elif _ODD_BLANKS.search(part):
                out.extend(map(self.words.__getitem__, self.tokenizer.words(part)))
            else:
                out.extend(map(self.chunks.__getitem__, part.split()))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_bytes(text)).tolist()


def count_words(docs: DataFrame, text_column: str, tokenizer_path: str) -> DataFrame:
    """(word, n) over all texts, of words that fit the lexicon."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, chunks = Tokenizer(tokenizer_path), Counter()

        def flush() -> pa.RecordBatch:
            words: Counter = Counter()
            for chunk, n in chunks.items():
                for word in tokenizer.words(chunk):
                    words[word] += n
            chunks.clear()
            kept = [(w, n) for w, n in words.items() if len(w.encode()) <= WORD_BYTES]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in texts(batch.column(0)):
                chunks.update(text.split())
            if len(chunks) > COUNTED:
                yield flush()
        yield flush()

    return docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> DataFrame:
    """At most size words, those of the highest counts, cut where the logarithm of the count steps."""
    counts = checkpoint(counts.withColumn("level", F.floor(F.log2("n") * 16).cast("int")))
    most, cut = 0, 1 << 30
    for r in sorted(counts.groupBy("level").count().collect(), reverse=True):  # some hundred levels at most
        most += r["count"]
        if most > size:
            break
        cut = r["level"]
    return counts.where(F.col("level") >= cut).select("word")


def build_lexicon(docs: DataFrame, tokenizer_path: str, text_column: str = "text", size: int = LEXICON_WORDS) -> str:
    """Compiles the most frequent words in a task and gives the name under which Spark ships the file to executors."""
    spark = docs.sparkSession
    top = frequent_words(count_words(docs, text_column, tokenizer_path), size)
    uri = fresh_dir(spark, "lexicon") + ".bin"

    def make(batches: list[pa.RecordBatch]) -> bytes:
        tokenizer = Tokenizer(tokenizer_path)
        entries = {w: tuple(tokenizer.merge(w)) for b in batches for w in b.column(0).to_pylist()}
        system, path = pafs.FileSystem.from_uri(uri)
        own = f"{path}.{uuid.uuid4().hex}"  # another attempt of the task may write as well
        with system.open_output_stream(own) as f:
            f.write(compile_lexicon(entries))
        system.move(own, path)
        return b"made"

    if not in_one_task(top, make):  # no task runs for an empty table
        make([])
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


_encoders: dict[tuple[str, str], Encoder] = {}


def _encoder(tokenizer_path: str, name: str) -> Encoder:
    """One per worker and lexicon; a worker that goes on to another lexicon drops the last."""
    key = (tokenizer_path, name)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Tokenizer(tokenizer_path), Lexicon(SparkFiles.get(name)))
    return _encoders[key]


def encode(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", lexicon: str | None = None) -> DataFrame:
    """doc_id, ids array<int> and decoded string, one row per document."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    name = lexicon or build_lexicon(docs, tokenizer_path, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, name)
        strings = encoder.tokenizer.strings
        for batch in pieces(batches, 4 << 20, tidy=False):
            parts = [encoder.encode_bytes(text) for text in texts(batch.column(1))]
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
            ids = np.frombuffer(b"".join(parts), np.int32)
            words = list(map(strings.__getitem__, ids.tolist()))
            decoded = [" ".join(words[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")
