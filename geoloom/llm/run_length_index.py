"""A run-length index: the runs of the Burrows-Wheeler transform of short texts, with samples at the runs' ends.

Suffixes are sorted by prefix doubling in numpy; a suffix ends with its text, and equal suffixes stand in order of
place. Inside a run of the transform two neighbours have the same character before them, so the neighbours of the
preceding suffixes are neighbours too and share one character more. The length that a suffix shares with its
neighbour above is therefore known from the sample at the run's upper end that follows from it, less the
distance; the same holds below with the lower ends. What is kept is a character and a length by run, and by run end the place of
its suffix and the length that it shares across the end; texts and sorted suffixes go once the index is built. Matching
statistics stream from the samples alone.
"""

from __future__ import annotations

import numpy as np

#: Characters of 9 bits in a first sort key.
PACKED = 6


class _Suffixes:
    """The sorted suffixes of the texts, while an index is built."""

    def __init__(self, texts: list[bytes], starts: np.ndarray):
        sizes = np.diff(starts)
        self.size = n = int(starts[-1])
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.left = (np.repeat(starts[1:], sizes) - np.arange(n)).astype(np.int32)  # characters up to the text's end
        self.code = np.zeros(n + PACKED, np.int64)
        symbols = np.zeros(n + PACKED, np.int16)
        symbols[:n] = self.text
        symbols[:n] += 1
        for k in range(PACKED):
            self.code[:n] <<= 9
            self.code[:n] |= np.where(self.left > k, symbols[k : k + n], np.int16(0))
        self.order = self._sort(int(sizes.max(initial=0)))

    def _sort(self, longest: int) -> np.ndarray:
        """Places in order, in 32 bits; what a step no longer needs goes before the next array is made."""
        n, depth, key = self.size, PACKED, self.code[: self.size]
        while True:
            order = np.argsort(key).astype(np.int32)
            key = key[order]
            new = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
            del key
            if new.all():
                return order
            rank = np.empty(n, np.int32)
            rank[order] = np.cumsum(new, dtype=np.int32)
            del order, new
            key = rank.astype(np.int64)
            key *= n + 1
            if depth >= longest:  # what is equal now stands in order of place
                key += np.arange(n, dtype=np.int32)
                return np.argsort(key).astype(np.int32)
            inside = np.flatnonzero(self.left > depth)
            key[inside] += rank[inside + depth]
            del rank, inside
            depth *= 2

    def transform(self, starts: np.ndarray) -> np.ndarray:
        """The character before each suffix, in order; each text's begin has a mark of its own."""
        first = np.zeros(self.size + 1, bool)
        first[starts] = True
        return np.where(first[self.order], -1 - self.order, self.text[self.order - 1]) if self.size else self.order

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Characters that the suffixes at a and b share from their begin."""
        length = np.zeros(len(a), np.int64)
        active = np.arange(len(a))
        while len(active):
            x, y = a[active] + length[active], b[active] + length[active]
            inside = (length[active] < self.left[a[active]]) & (length[active] < self.left[b[active]])
            cx, cy = self.code[np.where(inside, x, self.size)], self.code[np.where(inside, y, self.size)]
            differ = cx ^ cy
            same = np.full(len(active), PACKED)
            for k in range(PACKED):  # the first character that differs
                same[(differ >> (9 * (PACKED - 1 - k)) != 0) & (same == PACKED)] = k
            length[active[inside]] += same[inside]
            active = active[inside & (same == PACKED)]
        return np.minimum(length, np.minimum(self.left[a], self.left[b])) if len(a) else length


class RunLengthIndex:
    def __init__(self, texts: list[bytes]):
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.size = int(self.starts[-1])
        built = _Suffixes(texts, self.starts)
        before = built.transform(self.starts)
        edge = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]])) if self.size else np.zeros(0, np.int64)
        self.heads = before[edge].astype(np.int64)
        del before
        self.lengths = np.diff(np.concatenate([edge, [self.size]])) if self.size else edge
        self.above = self._samples(built, edge, -1)
        self.below = self._samples(built, edge + self.lengths - 1, 1)

    @staticmethod
    def _samples(built: _Suffixes, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Of run ends, in order of place: the place of the suffix and where what it shares with the next run ends."""
        places, other = built.order[at].astype(np.int64), at + step
        there = (other >= 0) & (other < built.size)
        shared = np.zeros(len(at), np.int64)
        shared[there] = built.shared(places[there], built.order[other[there]])
        by_place = np.argsort(places)
        return places[by_place], (places + shared)[by_place]

    def _stretches(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By sample the places that follow from it (first, past the last) and where their matches end."""
        return [(places, np.concatenate([places[1:], [self.size]]) if len(places) else places, ends) for places, ends in (self.above, self.below)]

    def matching_statistics(self) -> np.ndarray:
        """For each place, the longest match that begins there and also begins elsewhere."""
        out = np.zeros(self.size, np.int64)
        for first, past, ends in self._stretches():
            out = np.maximum(out, np.repeat(ends, past - first) - np.arange(self.size))
        return out

    def long_matches(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Stretches of places (first, last), none across two texts, at which a match of the least length or more begins."""
        found = [(first, np.minimum(past - 1, ends - least)) for first, past, ends in self._stretches()]
        first, last = (np.concatenate([f[k] for f in found]) for k in range(2))
        return first[last >= first], last[last >= first]
