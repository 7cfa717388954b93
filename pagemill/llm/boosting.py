"""Gradient-boosted trees on small feature matrices: logistic loss, binned splits."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Binary classifier: `rounds` trees of `depth` levels on quantile-binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.25, bins: int = 24):
        self.trees: list[list] = []
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))) if len(y) else -10.0
        if not len(y) or y.min() == y.max():
            return
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)
        f = np.full(len(y), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(b, y - p, p * (1 - p) + 1e-6, np.arange(len(y)), depth, rate)
            self.trees.append(tree)
            f += self._apply(tree, b)

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray, depth: int, rate: float) -> list:
        value = rate * g[at].sum() / (h[at].sum() + 1.0)
        if depth == 0 or len(at) < 20:
            return [value]
        best, total_g, total_h = (1e-3, -1, -1), g[at].sum(), h[at].sum()
        for j in range(b.shape[1]):
            n = len(self.edges[j]) + 1
            gl = np.cumsum(np.bincount(b[at, j], g[at], minlength=n))[:-1]
            hl = np.cumsum(np.bincount(b[at, j], h[at], minlength=n))[:-1]
            if len(gl):
                gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k)
        if best[1] < 0:
            return [value]
        left = b[at, best[1]] <= best[2]
        return [best[1], best[2], self._grow(b, g, h, at[left], depth - 1, rate), self._grow(b, g, h, at[~left], depth - 1, rate)]

    def _apply(self, tree: list, b: np.ndarray) -> np.ndarray:
        if len(tree) == 1:
            return np.full(len(b), tree[0])
        left = b[:, tree[0]] <= tree[1]
        out = np.empty(len(b))
        out[left], out[~left] = self._apply(tree[2], b[left]), self._apply(tree[3], b[~left])
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        if self.trees and len(x):
            b = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)
            for tree in self.trees:
                f += self._apply(tree, b)
        return 1 / (1 + np.exp(-f))
