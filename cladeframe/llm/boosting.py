"""Small gradient-boosted trees for the logistic loss, on bounded training samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class BoostedTrees:
    """Complete trees of `depth` levels; node i has children 2i + 1 and 2i + 2."""

    rounds: int = 40
    depth: int = 3
    rate: float = 0.2
    l2: float = 1.0
    base: float = 0.0
    trees: list = field(default_factory=list)
    scale: tuple[float, float] = (1.0, 0.0)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        p = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(p / (1 - p)))
        f = np.full(len(y), self.base)
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 24))) for j in range(x.shape[1])]
        bins = [np.searchsorted(values, x[:, j]) for j, values in enumerate(cuts)]
        for _ in range(self.rounds):
            q = sigmoid(f)
            tree = self._tree(bins, y - q, q * (1 - q), cuts)
            self.trees.append(tree)
            f += self.rate * self._walk(tree, x)
        return self

    def _tree(self, bins, g, h, cuts):
        """Greedy splits by gain, from sums per node, feature and bin: row i of feature j is at or
        below cut k where bins[j][i] <= k."""
        inner = 2**self.depth - 1
        feature, cut, leaf = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(2 ** (self.depth + 1) - 1)
        node = np.zeros(len(g), int)
        wide = max(map(len, cuts)) + 1
        for i in range(inner):
            own = np.flatnonzero(node == i)
            gi, hi = g[own], h[own]
            total, best = (gi.sum(), hi.sum()), 1e-6
            for j, values in enumerate(cuts):
                if len(own) <= 8:
                    break
                at = bins[j][own]
                a, b = (np.cumsum(np.bincount(at, w, wide))[: len(values)] for w in (gi, hi))
                gain = a * a / (b + self.l2) + (total[0] - a) ** 2 / (total[1] - b + self.l2) - total[0] ** 2 / (total[1] + self.l2)
                if len(gain) and gain.max() > best:
                    best, feature[i], cut[i] = gain.max(), j, values[gain.argmax()]
            k = np.searchsorted(cuts[feature[i]], cut[i])
            node[own] = 2 * i + 1 + (bins[feature[i]][own] > k)
        for i in range(inner, len(leaf)):
            own = node == i
            leaf[i] = g[own].sum() / (h[own].sum() + self.l2)
        return feature, cut, leaf

    def _walk(self, tree, x):
        feature, cut, leaf = tree
        node = np.zeros(len(x), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        return leaf[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((self._walk(t, x) for t in self.trees), np.zeros(len(x)))

    def calibrate(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> BoostedTrees:
        """Platt scaling on rows that fit() did not see: Newton steps to the optimum, which a
        ridge towards scale 1 and shift 0 keeps finite where the rows separate."""
        r = np.stack([self.raw(x), np.ones(len(x))], 1)
        prior = w = np.array([1.0, 0.0])
        loss = lambda w: np.logaddexp(0, r @ w).sum() - y @ (r @ w) + ridge / 2 * ((w - prior) ** 2).sum()
        for _ in range(100):
            q = sigmoid(r @ w)
            slope = r.T @ (q - y) + ridge * (w - prior)
            step = np.linalg.solve((r * (q * (1 - q))[:, None]).T @ r + ridge * np.eye(2), slope)
            while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
                step /= 2
            w = w - step
            if np.abs(step).max() < 1e-9:
                break
        self.scale = (max(float(w[0]), 0.05), float(w[1]))
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale[0] * self.raw(x) + self.scale[1])
