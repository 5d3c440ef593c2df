"""Gradient-boosted trees for a few classes: binned features, depth-wise trees, softmax loss."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    def __init__(self, classes: int, rounds: int = 40, depth: int = 4, rate: float = 0.25, penalty: float = 1.0, least: int = 8):
        self.classes, self.rounds, self.depth, self.rate, self.penalty, self.least = classes, rounds, depth, rate, penalty, least
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        z = self._bins(x)
        self.prior = np.log((np.bincount(y, minlength=self.classes) + 1) / (len(y) + self.classes))
        f, hot = np.tile(self.prior, (len(y), 1)), np.eye(self.classes)[y]
        for _ in range(self.rounds):
            p = _softmax(f)
            self.trees.append([self._tree(z, p[:, k] - hot[:, k], np.maximum(p[:, k] * (1 - p[:, k]), 1e-6)) for k in range(self.classes)])
            for k, t in enumerate(self.trees[-1]):
                f[:, k] += self._leaves(t, z)
        return self

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T)], 1).astype(np.uint8)

    def _tree(self, z: np.ndarray, g: np.ndarray, h: np.ndarray):
        """A complete tree as (feature, bin, leaf value); a node that doesn't split sends all to the left."""
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, 255, np.int64)
        at = np.zeros(len(z), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            if len(rows) >= 2 * self.least:
                best = 1e-6
                gs, hs, total, weight = g[rows], h[rows], g[rows].sum(), h[rows].sum()
                for k in range(z.shape[1]):
                    b = z[rows, k]
                    a, c, n = (np.cumsum(np.bincount(b, w, BINS))[:-1] for w in (gs, hs, None))
                    gain = a * a / (c + self.penalty) + (total - a) ** 2 / (weight - c + self.penalty) - total * total / (weight + self.penalty)
                    gain[(n < self.least) | (len(rows) - n < self.least)] = 0
                    i = int(gain.argmax())
                    if gain[i] > best:
                        best, feature[node], cut[node] = gain[i], k, i
            at[rows] = 2 * node + 1 + (z[rows, feature[node]] > cut[node])
        leaf = at - inner
        value = -self.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + self.penalty)
        return feature, cut, value

    def _leaves(self, tree, z: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at, rows = np.zeros(len(z), np.int64), np.arange(len(z))
        for _ in range(self.depth):
            at = 2 * at + 1 + (z[rows, feature[at]] > cut[at])
        return value[at - len(feature)]

    def log_proba(self, x: np.ndarray) -> np.ndarray:
        z = self._bins(x)
        f = np.tile(self.prior, (len(x), 1))
        for trees in self.trees:
            for k, t in enumerate(trees):
                f[:, k] += self._leaves(t, z)
        return np.log(np.clip(_softmax(f), 1e-6, 1))


def _softmax(f: np.ndarray) -> np.ndarray:
    e = np.exp(f - f.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)
