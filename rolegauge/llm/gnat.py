"""Nearest entry of a small table of integer vectors by a geometric near-neighbour access tree (GNAT), for many queries at once.

A node has up to FAN split points, chosen far apart; every other entry belongs to the child of its nearest split point. For each split point
and each child the node stores the smallest and largest distance from that point to the entries of the child (its own split point included).
A query that is `d` away from a split point is at least `low - d` and `d - high` away from every entry of a child with the range [low, high];
the child is dropped if that is more than the distance to the best entry so far.

Squared distances are exact integers, and ties go to the lower index by comparing them. Only the ranges are floating-point numbers: they are
widened by a relative error beyond that of a square root, and a child is dropped only if its bound is strictly larger, so neither rounding
nor a tie can lose an entry.
"""

from __future__ import annotations

import numpy as np

FAN = 5
LEAF = 6
WIDEN = 1e-9
#: Components up to this size have squared distances within 64 bits for parts of up to 2^16 components; larger ones are computed as Python integers.
PLAIN = 1 << 22


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between rows that broadcast against each other."""
    gap = a - b
    return (gap * gap).sum(axis=-1)


def root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


class Node:
    """`points`: indices of split points (or, in a leaf, of all entries); low, high: (points, children) distance ranges."""

    def __init__(self, entries: np.ndarray, members: np.ndarray):
        self.children: list[Node | None] = []
        if len(members) <= LEAF:
            self.points = members
            return
        self.points = self.split_points(entries, members)
        rest = np.setdiff1d(members, self.points)
        gaps = squared(entries[rest][:, None], entries[self.points][None])
        near = np.argmin(gaps, axis=1) if len(rest) else np.zeros(0, np.int64)
        groups = [rest[near == i] for i in range(len(self.points))]
        self.low = np.empty((len(self.points), len(self.points)))
        self.high = np.empty_like(self.low)
        for j, group in enumerate(groups):
            inside = entries[np.append(group, self.points[j])]
            far = root(squared(entries[self.points][:, None], inside[None]))
            self.low[:, j], self.high[:, j] = far.min(axis=1) * (1 - WIDEN), far.max(axis=1) * (1 + WIDEN)
        self.children = [Node(entries, group) if len(group) else None for group in groups]

    @staticmethod
    def split_points(entries: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Each next point is the one farthest from those chosen before."""
        chosen = [int(members[0])]
        gap = squared(entries[members], entries[chosen[0]])
        while len(chosen) < FAN and gap.max() > 0:
            chosen.append(int(members[int(np.argmax(gap))]))
            gap = np.minimum(gap, squared(entries[members], entries[chosen[-1]]))
        return np.array(chosen, np.int64)


class Gnat:
    """The tree of a table of entries, one row each. `computed` counts the distances of the last call of `nearest`."""

    def __init__(self, entries: np.ndarray):
        big = max((abs(int(x)) for x in entries.ravel()), default=0) > PLAIN
        self.entries = entries.astype(object) if big else entries.astype(np.int64)
        # Equal entries would make an empty split; only the first of them can be nearest.
        first = {tuple(row): i for i, row in reversed(list(enumerate(self.entries.tolist())))}
        self.top = Node(self.entries, np.array(sorted(first.values()), np.int64))
        self.computed = 0

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row: the index of its nearest entry (the lowest of equally near ones) and the squared distance."""
        kind = object if object in (queries.dtype, self.entries.dtype) else np.int64
        self.queries, self.table = queries.astype(kind), self.entries.astype(kind)
        self.index = np.full(len(queries), len(self.entries), np.int64)
        self.best = np.zeros(len(queries), self.queries.dtype)
        self.computed = 0
        self.search(self.top, np.arange(len(queries)))
        return self.index, self.best

    def look(self, point: int, rows: np.ndarray) -> np.ndarray:
        """Squared distances of the rows to an entry, which becomes their best where it is nearer, or as near with a lower index."""
        gap = squared(self.queries[rows], self.table[point])
        self.computed += len(rows)
        now, best = self.index[rows], self.best[rows]
        nearer = (now == len(self.entries)) | (gap < best) | ((gap == best) & (point < now))
        self.index[rows[nearer]], self.best[rows[nearer]] = point, gap[nearer]
        return gap

    def search(self, node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if not node.children:
            for point in node.points.tolist():
                self.look(point, rows)
            return
        bound = np.zeros((len(rows), len(node.children)))
        for i, point in enumerate(node.points.tolist()):
            far = root(self.look(point, rows))[:, None]
            bound = np.maximum(bound, np.maximum(node.low[i] - far * (1 + WIDEN), far * (1 - WIDEN) - node.high[i]))
        # The child of the nearest split point first: its entries make the best distance small for the others.
        for j in np.argsort(bound.sum(axis=0), kind="stable").tolist():
            if node.children[j] is not None:
                stays = bound[:, j] <= root(self.best[rows]) * (1 + WIDEN)
                self.search(node.children[j], rows[stays])
