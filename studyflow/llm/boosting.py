"""Histogram gradient-boosted trees for yes/no labels, kept as flat arrays.

Every tree is a full binary tree of fixed depth in one row of each array: the children of node i are 2i+1 and 2i+2. A node that was not split
sends all rows left and its descendants carry its value, so a walk of ``depth`` steps ends in a leaf for every row and tree at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows ``x``."""
        trees, rows = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return self.base + self.value[trees, node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def cuts_of(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Thresholds of each feature: its quantiles, each once."""
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, least: float = 8, ridge: float = 1.0) -> Trees:
    """Boost the logistic loss. ``least`` rows (weighted by 4 p (1-p)) stay on each side of a split. No rows give no trees and a score of 1/2."""
    n, width = x.shape
    nodes = 2 ** (depth + 1) - 1
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if n else 0.5
    model = Trees(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)), float(np.log(share / (1 - share))), depth)
    if not n or y.min() == y.max():
        return model
    cuts = cuts_of(x)
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
    limits = np.full((width, BINS), np.inf)
    for f in range(width):
        limits[f, : len(cuts[f])] = cuts[f]
    margin = np.full(n, model.base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        node = np.zeros(n, np.int64)
        for level in range(depth + 1):
            first, count = 2**level - 1, 2**level
            at = node - first
            g, h = np.bincount(at, grad, count), np.bincount(at, hess, count)
            value[first : first + count] = rate * g / (h + ridge)
            if level == depth:
                break
            gain, where = np.zeros((count, width)), np.zeros((count, width), np.int64)
            for f in range(width):
                code = at * BINS + binned[:, f]
                left_g = np.bincount(code, grad, count * BINS).reshape(count, BINS).cumsum(axis=1)
                left_h = np.bincount(code, hess, count * BINS).reshape(count, BINS).cumsum(axis=1)
                right_g, right_h = g[:, None] - left_g, h[:, None] - left_h
                better = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - (g**2 / (h + ridge))[:, None]
                better[(4 * np.minimum(left_h, right_h) < least) | (limits[f] == np.inf)[None, :]] = 0
                where[:, f] = better.argmax(axis=1)
                gain[:, f] = better[np.arange(count), where[:, f]]
            best = gain.argmax(axis=1)
            split = gain[np.arange(count), best] > 1e-9
            feature[first : first + count] = np.where(split, best, 0)
            bins = np.where(split, where[np.arange(count), best], BINS)
            threshold[first : first + count] = np.where(split, limits[best, np.minimum(bins, BINS - 1)], np.inf)
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > bins[at])
        # A node that was not split passes its value on to the left; the right side is never reached.
        margin += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), model.base, depth)


def area(y: np.ndarray, score: np.ndarray) -> float:
    """Chance that a row of label 1 scores above one of label 0 (ties count a half)."""
    order = np.unique(score, return_inverse=True)[1]
    counts = np.bincount(order)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[order]
    ones = int(y.sum())
    return float((rank[y == 1].sum() - ones * (ones + 1) / 2) / max(1, ones * (len(y) - ones)))
