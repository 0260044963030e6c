"""Gradient-boosted trees in numpy: logistic loss, binned features, trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """A row a tree: split features and thresholds of its inner nodes, values of its leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the rows."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - (len(leaf) - 1)]
        return total


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 50, depth: int = 4, bins: int = 32,
    rate: float = 0.2, ridge: float = 1.0,
) -> Trees:
    """Split by the gain of second-order boosting, among quantiles of each feature."""
    n, width = x.shape
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    mean = float(np.clip(y.mean(), 0.01, 0.99))
    base = float(np.log(mean / (1 - mean)))
    score = np.full(n, base)
    made = Trees(
        np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf),
        np.zeros((trees, 2**depth)), base,
    )
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            place = (at - first) * bins
            for f in range(width):
                key = place + binned[:, f]
                left_g = np.bincount(key, g, count * bins).reshape(count, bins).cumsum(axis=1)
                left_h = np.bincount(key, h, count * bins).reshape(count, bins).cumsum(axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = (
                    left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge)
                    - all_g**2 / (all_h + ridge)
                )[:, : len(edges[f])]
                if not gain.shape[1]:
                    continue
                where = gain.argmax(axis=1)
                for k in np.flatnonzero(gain.max(axis=1) > best + 1e-6):
                    best[k] = gain[k, where[k]]
                    made.feature[t, first + k] = f
                    made.threshold[t, first + k] = edges[f][where[k]]
            at = 2 * at + 1 + (x[np.arange(n), made.feature[t][at]] > made.threshold[t][at])
        at -= 2**depth - 1
        made.leaf[t] = -rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + ridge)
        score += made.leaf[t][at]
    return made
