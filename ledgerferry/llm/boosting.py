"""Gradient-boosted regression trees for a yes-or-no label, on binned features, in numpy."""

from __future__ import annotations

import numpy as np

from ledgerferry.llm.common import sigmoid

BINS = 32


class Boosted:
    """Trees of equal depth, stored as arrays: the split of each inner node, the value of each leaf."""

    def __init__(self, edges: np.ndarray, base: float, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        self.edges, self.base, self.feature, self.cut, self.value = edges, base, feature, cut, value

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T, strict=True)], 1).astype(np.int8)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b, out, rows = self.bins(x), np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(value)))):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, least: float = 5.0, ridge: float = 1.0) -> Boosted:
    """Newton steps on the logistic loss; a split is the best cut of any binned feature."""
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    model = Boosted(edges, base, np.zeros((0, 2**depth - 1), int), np.zeros((0, 2**depth - 1), int), np.zeros((0, 2**depth)))
    b, f, d = model.bins(x).astype(np.int64), np.full(len(y), base), x.shape[1]
    features, cuts, values = [], [], []
    for _ in range(trees):
        p = sigmoid(f)
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2**depth - 1, int), np.full(2**depth - 1, BINS)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            spot = node - first
            gain = np.full((wide, d, BINS), -np.inf)
            for k in range(d):
                at = spot * BINS + b[:, k]
                left_g = np.bincount(at, g, wide * BINS).reshape(wide, BINS).cumsum(1)
                left_h = np.bincount(at, h, wide * BINS).reshape(wide, BINS).cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                score = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
                gain[:, k] = np.where((left_h * 4 >= least / 4) & (right_h * 4 >= least / 4), score, -np.inf)
            flat = gain.reshape(wide, -1)
            best = flat.argmax(1)
            split = flat[np.arange(wide), best] > 1e-6
            feature[first : first + wide] = np.where(split, best // BINS, 0)
            cut[first : first + wide] = np.where(split, best % BINS, BINS)
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        f += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Boosted(edges, base, np.array(features), np.array(cuts), np.array(values))
