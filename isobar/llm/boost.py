"""Histogram gradient-boosted trees, kept as flat arrays."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: a row per tree, nodes in level order; the right child takes values above the threshold."""

    features: np.ndarray  # (trees, 2**depth - 1)
    thresholds: np.ndarray
    leaves: np.ndarray  # (trees, 2**depth)
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row, all rows going down a tree together."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        depth = inner.bit_length()
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - inner]
        return total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))

    def sql(self, columns: Sequence[str]) -> str:
        """The log-odds as a SQL expression over columns."""
        inner = self.features.shape[1]

        def branch(tree: int, node: int) -> str:
            if node >= inner:
                return f"{float(self.leaves[tree, node - inner])!r}D"
            left, right = branch(tree, 2 * node + 1), branch(tree, 2 * node + 2)
            column, threshold = columns[self.features[tree, node]], float(self.thresholds[tree, node])
            if left == right or threshold == float("inf"):
                return left
            return f"IF({column} > {threshold!r}D, {right}, {left})"

        return " + ".join([f"{self.base!r}D", *(branch(t, 0) for t in range(len(self.features)))])


def fit(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, trees: int = 60, depth: int = 4,
    rate: float = 0.2, bins: int = 64, least_weight: float = 5.0, ridge: float = 1.0,
) -> Forest:
    """Fit 0/1 labels by Newton boosting on histograms of binned features; the result depends on the input alone.

    With no rows, or one class, the forest gives that class's smoothed share everywhere.
    """
    weights = np.ones(len(y)) if weights is None else np.asarray(weights, float)
    share = (float((weights * y).sum()) + 0.5) / (float(weights.sum()) + 1.0)
    base = float(np.log(share / (1 - share)))
    inner, n_features = 2**depth - 1, x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]) if len(x) else np.zeros((n_features, 0), int)
    features = np.zeros((trees, inner), np.int64)
    thresholds = np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, inner + 1))
    margin = np.full(len(y), base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = weights * (y - p), weights * np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = at - first
            best = np.full(count, 1e-6)
            for f in range(n_features):
                width = len(edges[f]) + 1
                if width == 1:
                    continue
                cell = local * width + binned[f]
                sums = [np.bincount(cell, v, count * width).reshape(count, width) for v in (gradient, curvature, weights)]
                left = [s.cumsum(axis=1)[:, :-1] for s in sums]
                whole = [s.sum(axis=1, keepdims=True) for s in sums]
                right = [w - part for w, part in zip(whole, left)]
                gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - whole[0] ** 2 / (whole[1] + ridge)
                gain[(left[2] < least_weight) | (right[2] < least_weight)] = 0
                cut = gain.argmax(axis=1)
                gains = gain[np.arange(count), cut]
                for node in np.flatnonzero(gains > best):
                    best[node] = gains[node]
                    features[tree, first + node] = f
                    thresholds[tree, first + node] = edges[f][cut[node]]
            feature, threshold = features[tree, at], thresholds[tree, at]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature] > threshold)
        leaf = at - inner
        g = np.bincount(leaf, gradient, inner + 1)
        h = np.bincount(leaf, curvature, inner + 1)
        leaves[tree] = rate * g / (h + ridge)
        margin += leaves[tree, leaf]
    return Forest(features, thresholds, leaves, base)
