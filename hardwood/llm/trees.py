"""Gradient-boosted trees on dense features and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Tree:
    """Nodes in breadth-first order: inner node k has children 2k+1 and 2k+2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            split = self.feature[node]
            right = x[rows, np.maximum(split, 0)] > self.cut[node]
            node = np.where(split >= 0, 2 * node + 1 + right, node)
        return self.value[node]


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Cut points of each feature at its quantiles."""
    return [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]


def grow(
    binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray, depth: int, least: int, penalty: float
) -> Tree:
    """One tree on histograms of gradients; a node splits where the gain is largest (ties: lowest feature, then lowest cut)."""
    size = 2 ** (depth + 1) - 1
    feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
    members = {0: np.arange(len(binned))}
    for node in range(size):
        rows = members.pop(node, None)
        if rows is None:
            continue
        g, h = gradient[rows].sum(), curvature[rows].sum()
        value[node] = -g / (h + penalty)
        if 2 * node + 2 >= size or len(rows) < 2 * least:
            continue
        best = (1e-9, -1, 0)
        for f in range(binned.shape[1]):
            codes, k = binned[rows, f], len(edges[f]) + 1
            gl = np.cumsum(np.bincount(codes, gradient[rows], k))[:-1]
            hl = np.cumsum(np.bincount(codes, curvature[rows], k))[:-1]
            nl = np.cumsum(np.bincount(codes, minlength=k))[:-1]
            gain = gl**2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty) - g**2 / (h + penalty)
            gain[(nl < least) | (len(rows) - nl < least)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
        if best[1] >= 0:
            feature[node], cut[node] = best[1], edges[best[1]][best[2]]
            left = binned[rows, best[1]] <= best[2]
            members[2 * node + 1], members[2 * node + 2] = rows[left], rows[~left]
    return Tree(feature, cut, value, depth)


@dataclass
class Boosted:
    start: float
    trees: list[Tree]
    rate: float
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.start + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability, with a hundredth of the plain one so that rows within a pool keep their order; without calibration the logistic of the margin."""
        margin = self.margin(x)
        plain = 1 / (1 + np.exp(-margin))
        return plain if self.steps is None else 0.99 * np.interp(margin, *self.steps) + 0.01 * plain


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, least: int = 10, penalty: float = 1.0) -> Boosted:
    """Logistic loss, Newton steps. One class alone gives its smoothed share for all rows."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Boosted(float(np.log(share / (1 - share))), [], rate)
    if len(np.unique(y)) < 2:
        return model
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    margin = np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(binned, edges, p - y, p * (1 - p), depth, least, penalty)
        model.trees.append(tree)
        margin += rate * tree.predict(x)
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Knots of the least-squares nondecreasing fit by pooling neighbours; None if one class is missing.

    Shares are kept off 0 and 1 by what one imagined row among all would add.
    """
    if len(np.unique(y)) < 2:
        return None
    # Rows of equal margin are one pool from the start.
    level, of = np.unique(margin, return_inverse=True)
    rows, ones = np.bincount(of), np.bincount(of, y)
    pools: list[list[float]] = []  # sum of labels, rows, sum of margins
    for m, n, label in zip(level.tolist(), rows.tolist(), ones.tolist()):
        pools.append([label, float(n), m * n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    knots = np.array([[s / n, t / n] for t, n, s in pools])
    edge = 1 / (len(y) + 2)
    return knots[:, 0], np.clip(knots[:, 1], edge, 1 - edge)
