"""Gradient-boosted trees for a logistic loss, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: feature and threshold of each inner node, value of each leaf."""

    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (len(f))]
        return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: float = 5.0, share: float = 1.0) -> Trees:
    """Second-order boosting with histograms; each tree may split on a `share` of the features, drawn anew.

    A node without a good split sends all rows to the left.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]).astype(np.uint8)
    usable, drawn = np.array([j for j, e in enumerate(edges) if len(e)]), np.random.default_rng(n)
    inner, mean = 2**depth - 1, np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    logit = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        f, t, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.full(inner, bins + 1)
        at = np.zeros(n, dtype=np.int64)
        mine = usable if share >= 1 else np.sort(drawn.choice(usable, max(1, int(len(usable) * share)), replace=False))
        for level in range(depth):
            first, size = 2**level - 1, 2**level
            best = np.zeros(size)
            local = at - first
            for j in mine:
                e = edges[j]
                key = local * (bins + 1) + binned[j]
                gs = np.bincount(key, g, size * (bins + 1)).reshape(size, -1).cumsum(axis=1)
                hs = np.bincount(key, h, size * (bins + 1)).reshape(size, -1).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                gain[(hs < least) | (ht - hs < least)] = 0
                gain = gain[:, : len(e)]
                k = gain.argmax(axis=1)
                better = gain[np.arange(size), k] > best + 1e-9
                best[better] = gain[np.arange(size), k][better]
                nodes = np.flatnonzero(better) + first
                f[nodes], t[nodes], cut[nodes] = j, e[k[better]], k[better]
            at = 2 * at + 1 + (binned[f[at], np.arange(n)] > cut[at])
        leaf = at - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        logit += value[leaf]
        features.append(f), thresholds.append(t), values.append(value)
    return Trees(depth, np.array(features), np.array(thresholds), np.array(values), base)
