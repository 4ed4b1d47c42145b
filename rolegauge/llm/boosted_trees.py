"""Gradient-boosted trees with logistic loss in numpy. Splits on constrained features keep the prediction monotonic; a fitted model is a
set of flat node arrays, and a table of rows is scored level by level without a loop over rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Node arrays, one row per tree. A leaf points to itself, so all rows take the same number of steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds for each row."""
        total = np.full(len(rows), self.start)
        index = np.arange(len(rows))
        for tree in range(len(self.feature)):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                above = rows[index, self.feature[tree, node]] > self.threshold[tree, node]
                node = np.where(above, self.right[tree, node], self.left[tree, node])
            total += self.value[tree, node]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(rows)))


def constant(start: float) -> Trees:
    """The model without trees."""
    empty = np.zeros((0, 1))
    return Trees(empty.astype(np.int64), empty, empty.astype(np.int64), empty.astype(np.int64), empty, start, 0)


def fit(
    rows: np.ndarray, label: np.ndarray, direction: np.ndarray, rounds: int = 60, depth: int = 3, bins: int = 48, rate: float = 0.2,
    least: int = 10, ridge: float = 1.0,
) -> Trees:
    """`direction` holds +1 (never decreasing), -1 (never increasing) or 0 for each feature. Without rows, or with one class only, the
    model is constant."""
    n, width = rows.shape
    share = (label.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    if n < 2 * least or label.min() == label.max():
        return constant(start)
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], rows[:, f], side="left") for f in range(width)], axis=1)
    nodes = 2 ** (depth + 1) - 1
    shape = (rounds, nodes)
    feature, left, right = np.zeros(shape, np.int64), np.tile(np.arange(nodes), (rounds, 1)), np.tile(np.arange(nodes), (rounds, 1))
    threshold, value = np.full(shape, np.inf), np.zeros(shape)
    score = np.full(n, start)
    for tree in range(rounds):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = label - p, p * (1 - p)
        members = {0: np.arange(n)}
        bounds = {0: (-np.inf, np.inf)}
        for node in range(nodes):
            if node not in members:
                continue
            at = members[node]
            low, high = bounds[node]
            own = gradient[at].sum() / (weight[at].sum() + ridge)
            value[tree, node] = rate * np.clip(own, low, high)
            if 2 * node + 2 >= nodes or len(at) < 2 * least:
                continue
            best = best_split(binned[at], gradient[at], weight[at], edges, direction, (low, high), least, ridge)
            if best is None:
                continue
            f, cut, middle = best
            above = binned[at, f] > cut
            feature[tree, node], threshold[tree, node] = f, edges[f][cut]
            left[tree, node], right[tree, node] = 2 * node + 1, 2 * node + 2
            members[2 * node + 1], members[2 * node + 2] = at[~above], at[above]
            up, down = (low, middle), (middle, high)
            bounds[2 * node + 1], bounds[2 * node + 2] = {1: (up, down), -1: (down, up), 0: ((low, high),) * 2}[int(direction[f])]
        model = Trees(feature[tree : tree + 1], threshold[tree : tree + 1], left[tree : tree + 1], right[tree : tree + 1], value[tree : tree + 1], 0.0, depth)
        score += model.raw(rows)
    return Trees(feature, threshold, left, right, value, start, depth)


def best_split(binned, gradient, weight, edges, direction, bounds, least, ridge):
    """(feature, bin, middle of the two leaf values) with the largest gain that keeps the constraints, or None."""
    best, found = 1e-6, None
    whole = gradient.sum() ** 2 / (weight.sum() + ridge)
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        size = len(cuts) + 1
        g = np.cumsum(np.bincount(binned[:, f], gradient, size))[:-1]
        h = np.cumsum(np.bincount(binned[:, f], weight, size))[:-1]
        c = np.cumsum(np.bincount(binned[:, f], minlength=size))[:-1]
        low = np.clip(g / (h + ridge), *bounds)
        high = np.clip((gradient.sum() - g) / (weight.sum() - h + ridge), *bounds)
        gain = g**2 / (h + ridge) + (gradient.sum() - g) ** 2 / (weight.sum() - h + ridge) - whole
        gain[(c < least) | (len(binned) - c < least)] = -np.inf
        if direction[f]:
            gain[direction[f] * (high - low) < 0] = -np.inf
        cut = int(np.argmax(gain))
        if gain[cut] > best:
            best, found = gain[cut], (f, cut, (low[cut] + high[cut]) / 2)
    return found
