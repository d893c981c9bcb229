"""Gradient-boosted trees with logistic loss on binned features, small enough to be fitted on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: a feature and a bin for each inner node, a value for each leaf."""

    cuts: list[np.ndarray]
    features: np.ndarray
    limits: np.ndarray
    values: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = _binned(x, self.cuts)
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.values.shape[1]))
        for features, limits, values in zip(self.features, self.limits, self.values, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (binned[rows, features[node]] > limits[node])
            out += values[node - (1 << depth) + 1]
        return out


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1).astype(np.uint8)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3, least: float = 4.0) -> Trees:
    """Second-order boosting; every level splits on the best (feature, bin) of each node."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = _binned(x, cuts)
    n, width = binned.shape
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(n, base)
    all_features, all_limits, all_values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        inner = (1 << depth) - 1
        features, limits = np.zeros(inner, np.int64), np.full(inner, 255, np.int64)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            own = node - first
            gains = np.full((width, count), -np.inf)
            best_bins = np.zeros((width, count), np.int64)
            for k in range(width):
                cell = own * BINS + binned[:, k]
                g = np.bincount(cell, gradient, count * BINS).reshape(count, BINS).cumsum(axis=1)
                h = np.bincount(cell, weight, count * BINS).reshape(count, BINS).cumsum(axis=1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < least) | (ht - hl < least)] = -np.inf
                best_bins[k] = gain.argmax(axis=1)
                gains[k] = gain.max(axis=1)
            chosen = gains.argmax(axis=0)
            for c in range(count):
                if gains[chosen[c], c] > 0:
                    features[first + c], limits[first + c] = chosen[c], best_bins[chosen[c], c]
            node = 2 * node + 1 + (binned[np.arange(n), features[node]] > limits[node])
        leaf = node - inner
        values = rate * np.bincount(leaf, gradient, 1 << depth) / (np.bincount(leaf, weight, 1 << depth) + 1)
        score += values[leaf]
        all_features.append(features)
        all_limits.append(limits)
        all_values.append(values)
    return Trees(cuts, np.array(all_features), np.array(all_limits), np.array(all_values), base)
