"""Histogram gradient-boosted trees in numpy: fitted on a bounded sample,
flattened into arrays, scored by vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth.  Inner node i of a tree has the
    children 2i+1 (value <= bound) and 2i+2; leaves follow the inner nodes."""
    feature: np.ndarray  # (trees, inner nodes)
    bound: np.ndarray  # (trees, inner nodes)
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, b, leaf in zip(self.feature, self.bound, self.leaf):
            node = np.zeros(len(x), np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > b[node])
            out += leaf[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 60, depth: int = 4,
        rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Trees for the probability of y = 1 by Newton boosting on histograms.
    Without rows the score is 1/2; with one class it is its smoothed share."""
    n, m = x.shape
    inner = 2 ** depth - 1
    w = np.ones(n) if weight is None else weight
    share = (float((w * y).sum()) + 0.5) / (float(w.sum()) + 1.0)
    base = float(np.log(share / (1 - share)))
    feature = np.zeros((trees, inner), np.int64)
    bound = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if not n or not m or y.min() == y.max():
        return Trees(feature[:0], bound[:0], leaf[:0], base)
    # Bounds lie half-way between neighbouring values at quantiles.
    cuts = []
    for j in range(m):
        v = np.unique(x[:, j])
        if len(v) > bins:
            v = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1), method="lower"))
        cuts.append((v[1:] + v[:-1]) / 2)
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    width = bins + 1
    flat = code + np.arange(m) * width
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            k = 2 ** level
            index = (node[:, None] * (m * width) + flat).ravel()
            size = k * m * width
            gs = np.bincount(index, np.repeat(g, m), size).reshape(k, m, width).cumsum(2)
            hs = np.bincount(index, np.repeat(h, m), size).reshape(k, m, width).cumsum(2)
            g_all, h_all = gs[:, :1, -1:], hs[:, :1, -1:]
            gr, hr = g_all - gs, h_all - hs
            gain = gs ** 2 / (hs + ridge) + gr ** 2 / (hr + ridge) - g_all ** 2 / (h_all + ridge)
            gain[(hs < least) | (hr < least)] = -np.inf
            best = gain.reshape(k, -1).argmax(1)
            f, b = np.divmod(best, width)
            good = gain.reshape(k, -1)[np.arange(k), best] > 1e-9
            at = k - 1 + np.arange(k)
            feature[t, at] = np.where(good, f, 0)
            bound[t, at] = [cuts[j][i] if ok and i < len(cuts[j]) else np.inf for j, i, ok in zip(f, b, good)]
            f, b = np.where(good, f, 0), np.where(good, b, width)
            node = 2 * node + (code[np.arange(n), f[node]] > b[node])
        gs, hs = np.bincount(node, g, inner + 1), np.bincount(node, h, inner + 1)
        leaf[t] = -rate * gs / (hs + ridge)
        margin += leaf[t][node]
    return Trees(feature, bound, leaf, base)
