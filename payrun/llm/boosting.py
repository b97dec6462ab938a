"""Gradient-boosted trees on binned features, in numpy; small enough to ship to tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BoostedTrees:
    """Logistic loss, complete trees of ``depth`` levels grown on histograms."""

    rounds: int = 40
    depth: int = 3
    rate: float = 0.3
    ridge: float = 1.0
    bins: int = 32
    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        cuts = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], cuts)) for j in range(x.shape[1])]
        b = self.binned(x)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = sigmoid(margin)
            tree = self._grow(b, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += self._leaf(tree, b)
        return self

    def _grow(self, b, grad, hess):
        n_inner, width = (1 << self.depth) - 1, self.bins + 1
        feature, cut = np.zeros(n_inner, int), np.full(n_inner, width, int)
        node = np.zeros(len(b), int)
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.full(count, 1e-9)
            for j in range(b.shape[1]):
                at = (node - first) * width + b[:, j]
                g = np.bincount(at, grad, count * width).reshape(count, width).cumsum(1)
                h = np.bincount(at, hess, count * width).reshape(count, width).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = (g ** 2 / (h + self.ridge) + (g_all - g) ** 2 / (h_all - h + self.ridge)
                        - g_all ** 2 / (h_all + self.ridge))
                top = gain.argmax(1)
                value = gain[np.arange(count), top]
                better = value > best
                best = np.where(better, value, best)
                feature[first:first + count][better] = j
                cut[first:first + count][better] = top[better]
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        leaf = node - n_inner
        g = np.bincount(leaf, grad, 1 << self.depth)
        h = np.bincount(leaf, hess, 1 << self.depth)
        return feature, cut, -self.rate * g / (h + self.ridge)

    def _leaf(self, tree, b):
        feature, cut, value = tree
        node = np.zeros(len(b), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        return value[node - len(feature)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return self.start + sum((self._leaf(t, b) for t in self.trees), np.zeros(len(b)))


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and offset that make ``sigmoid(a * margin + b)`` a calibrated probability."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - target * z).sum())

    w = np.array([0.0, np.log((y.sum() + 1) / ((1 - y).sum() + 1))])
    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target))
        scale = 1.0
        while scale > 1e-4 and loss(w - scale * step) > now:      # Newton steps that overshoot are halved
            scale /= 2
        if scale <= 1e-4 or np.abs(step).max() < 1e-6:
            break
        w = w - scale * step
        now = loss(w)
    return float(w[0]), float(w[1])
