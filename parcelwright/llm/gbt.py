"""Histogram gradient-boosted trees for a yes/no label, in numpy.

Trees are grown level by level from histograms of binned features and kept as flat
arrays (feature, threshold, value; the children of node i are 2i + 1 and 2i + 2), so
that a batch of rows walks all trees with a few array operations a level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """feature, threshold and value have a row for each tree and a column for each node."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of x."""
        n, trees = len(x), len(self.feature)
        total = np.full(n, self.base)
        rows = np.arange(n)
        for t in range(trees):
            node = np.zeros(n, np.int32)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t][node]] > self.threshold[t][node])
            total += self.value[t][node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, least: int = 20, ridge: float = 1.0) -> Trees:
    """Fits trees to rows x (float) and labels y (0 or 1). Without rows, or with one label
    only, the score is constant."""
    nodes = 2 ** (depth + 1) - 1
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, nodes), np.int32), np.zeros((0, nodes)), np.zeros((0, nodes)), depth, base)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    edges = np.full((width, bins), np.inf)
    for f, c in enumerate(cuts):
        edges[f, : len(c)] = c
    feature = np.zeros((trees, nodes), np.int32)
    threshold = np.full((trees, nodes), np.inf)
    value = np.zeros((trees, nodes))
    score = np.full(n, base)
    flat = binned + np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            size = count * width * bins
            at = (local[:, None] * (width * bins) + flat).reshape(-1)
            shape = (count, width, bins)
            hg = np.bincount(at, np.repeat(g, width), size).reshape(shape).cumsum(axis=2)
            hh = np.bincount(at, np.repeat(h, width), size).reshape(shape).cumsum(axis=2)
            hn = np.bincount(at, minlength=size).reshape(shape).cumsum(axis=2)
            tg, th, tn = hg[:, :, -1:], hh[:, :, -1:], hn[:, :, -1:]
            gain = hg**2 / (hh + ridge) + (tg - hg) ** 2 / (th - hh + ridge) - tg**2 / (th + ridge)
            gain[(hn < least) | (tn - hn < least) | ~np.isfinite(edges)[None]] = -1
            best = gain.reshape(count, -1).argmax(axis=1)
            f, b = best // bins, best % bins
            split = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            feature[t, first : first + count] = np.where(split, f, 0)
            threshold[t, first : first + count] = np.where(split, edges[f, b], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[t][node]] > threshold[t][node])
        first, count = 2**depth - 1, 2**depth
        sums_g, sums_h = np.bincount(node - first, g, count), np.bincount(node - first, h, count)
        value[t, first:] = -rate * sums_g / (sums_h + ridge)
        score += value[t][node]
    return Trees(feature, threshold, value, depth, base)
