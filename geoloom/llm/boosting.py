"""Histogram gradient-boosted trees in numpy: trained on binned features, kept as flat arrays, traversed in bulk."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete trees of one depth: node k of a tree has children 2k+1 and 2k+2."""

    depth: int
    base: float
    feature: np.ndarray  # trees x (2**depth - 1)
    cut: np.ndarray  # same shape; a row goes right if its feature is greater
    leaf: np.ndarray  # trees x 2**depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (len(leaf) - 1)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Forest:
    """Logistic loss; y is 0 or 1. Splits with the best gain in a histogram of quantile bins; a node without gain sends all rows left."""
    n, width = x.shape
    if not n:
        return Forest(depth, 0.0, np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], 1)
    mean = np.clip(y.mean(), 0.01, 0.99)
    base = float(np.log(mean / (1 - mean)))
    score = np.full(n, base)
    shape = (trees, 2**depth - 1)
    forest = Forest(depth, base, np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros((trees, 2**depth)))
    offsets = np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * width * bins + offsets + binned).ravel()
            hist = lambda v: np.bincount(slot, np.repeat(v, width), many * width * bins).reshape(many, width, bins)  # noqa: E731, B023
            gl, hl = hist(g).cumsum(2), hist(h).cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(hl < least) | (ht - hl < least)] = 0
            flat = gain.reshape(many, -1)
            best = flat.argmax(1)
            for k in range(many):
                f, at = divmod(int(best[k]), bins)
                if flat[k, best[k]] > 1e-9 and at < len(cuts[f]):
                    forest.feature[t, first + k], forest.cut[t, first + k] = f, cuts[f][at]
            node = 2 * node + 1 + (x[np.arange(n), forest.feature[t, node]] > forest.cut[t, node])
        slot = node - (2**depth - 1)
        forest.leaf[t] = -rate * np.bincount(slot, g, 2**depth) / (np.bincount(slot, h, 2**depth) + l2)
        score += forest.leaf[t, slot]
    return forest
