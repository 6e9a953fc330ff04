"""Histogram gradient-boosted trees in numpy: small models, trained on bounded samples.

A model is a handful of arrays. Every tree is complete, so a row's way through all of them is plain
index arithmetic on whole columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Boosted:
    """``feature`` and ``threshold`` have one row per tree, one column per inner node (root first, the
    children of i at 2i + 1 and 2i + 2); ``leaf`` has the values of the last level."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = (self.leaf.shape[1] - 1).bit_length()
        for f, t, v in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += v[at - (self.leaf.shape[1] - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 5.0, ridge: float = 1.0
) -> Boosted:
    """Logistic loss; ``least`` is the smallest sum of hessians times 4 in a child, about its rows."""
    inner, leaves = 2**depth - 1, 2**depth
    nothing = (np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(y) == 0:
        return Boosted(0.0, *nothing)
    mean = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return Boosted(base, *nothing)
    n_features = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]).astype(np.int64)
    usable = np.zeros((n_features, BINS), dtype=bool)
    for f, c in enumerate(cuts):
        usable[f, : len(c)] = True
    offsets = np.arange(n_features) * BINS
    margin = np.full(len(y), base)
    out_f, out_t, out_v = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            cell = ((at - first)[:, None] * (n_features * BINS) + offsets + binned).ravel()
            shape = (nodes, n_features, BINS)
            gs = np.bincount(cell, np.repeat(g, n_features), nodes * n_features * BINS).reshape(shape).cumsum(axis=2)
            hs = np.bincount(cell, np.repeat(h, n_features), nodes * n_features * BINS).reshape(shape).cumsum(axis=2)
            g_all, h_all = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + ridge) + (g_all - gs) ** 2 / (h_all - hs + ridge) - g_all**2 / (h_all + ridge)
            allowed = usable & (4 * hs >= least) & (4 * (h_all - hs) >= least)
            gain = np.where(allowed, gain, 0.0).reshape(nodes, -1)
            best = gain.argmax(axis=1)
            for node in np.flatnonzero(gain[np.arange(nodes), best] > 1e-6).tolist():
                f, b = divmod(int(best[node]), BINS)
                feature[first + node], threshold[first + node] = f, cuts[f][b]
            go_right = x[np.arange(len(y)), feature[at]] > threshold[at]
            at = 2 * at + 1 + go_right
        at -= inner
        value = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + ridge)
        margin += value[at]
        out_f.append(feature)
        out_t.append(threshold)
        out_v.append(value)
    return Boosted(base, np.array(out_f), np.array(out_t), np.array(out_v))
