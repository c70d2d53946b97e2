"""Signature trees over sets: hierarchical nodes with OR-combined bitmaps and size ranges.

A set's bitmap has a bit for each element's hash.  A bit of x that y lacks stands for
at least one element that y lacks, so |x & y| <= |x| - bits(x without y).  A node
holds the OR of its members' bitmaps and their least and greatest size; for a set x
and a node the same bound holds with the node's bitmap, and between two nodes the
bound is taken for the fewest bits any member has.  A pair of nodes is left alone if
even the greatest overlap would not reach the similarity, or if all members of both
are known to be connected.
"""

from __future__ import annotations

import numpy as np

LEAF, FAN = 16, 8
#: Similarity, as a fraction.
NUMERATOR, DENOMINATOR = 75, 100


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest intersection with which sets of these sizes are similar (J >= 3/4)."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def ones(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(-1, dtype=np.int64)


class Tree:
    """Nodes by level, leaves first; members are sorted by size and then by their bitmaps."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, labels: np.ndarray) -> None:
        order = np.lexsort((bits[:, 0], labels, sizes))
        self.order = order
        self.sizes, self.bits, self.labels = sizes[order], bits[order], labels[order]
        n = len(order)
        edges = np.arange(0, n, LEAF)
        self.levels = [self._level(np.append(edges, n))]
        while len(edges) > 1:
            edges = edges[::FAN]
            self.levels.append(self._level(np.append(edges, n)))

    def _level(self, edges: np.ndarray) -> dict[str, np.ndarray]:
        first, last = edges[:-1], edges[1:]
        return {
            "first": first, "last": last,
            "or": np.bitwise_or.reduceat(self.bits, first, axis=0),
            "and": np.bitwise_and.reduceat(self.bits, first, axis=0),
            "least": self.sizes[first], "most": self.sizes[last - 1],
            "label": np.where(
                np.minimum.reduceat(self.labels, first) == np.maximum.reduceat(self.labels, first), self.labels[first], -1
            ),
        }

    def pairs(self, other: Tree | None = None) -> np.ndarray:
        """Rows (i, j) of members that may be similar and are not known to be connected.

        Without ``other`` both are of this tree, each pair once.
        """
        mine = other is None
        other = self if other is None else other
        found: list[np.ndarray] = []
        top = len(self.levels) - 1, len(other.levels) - 1
        work = [(np.zeros(1, np.int64), np.zeros(1, np.int64), *top)]
        while work:
            a, b, la, lb = work.pop()
            keep = self._possible(a, b, self.levels[la], other.levels[lb])
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if la == 0 and lb == 0:
                found.extend(self._members(i, j, other, mine) for i, j in zip(a, b, strict=True))
                continue
            if la >= lb:  # open the higher side
                a, b = self._open(a, b, la, len(self.levels[la - 1]["first"]))
                la -= 1
            else:
                b, a = self._open(b, a, lb, len(other.levels[lb - 1]["first"]))
                lb -= 1
            if mine and la == lb:
                inside = b >= a
                a, b = a[inside], b[inside]
            step = max(64, (1 << 21) // self.bits.shape[1])
            work.extend((a[i : i + step], b[i : i + step], la, lb) for i in range(0, len(a), step))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return np.column_stack([self.order[pairs[:, 0]], other.order[pairs[:, 1]]])

    @staticmethod
    def _open(high: np.ndarray, low: np.ndarray, level: int, children: int) -> tuple[np.ndarray, np.ndarray]:
        opened = (high[:, None] * FAN + np.arange(FAN)).ravel()
        kept = opened < children
        return opened[kept], np.repeat(low, FAN)[kept]

    @staticmethod
    def _possible(a: np.ndarray, b: np.ndarray, x: dict, y: dict) -> np.ndarray:
        apart = (x["label"][a] != y["label"][b]) | (x["label"][a] < 0)
        near = (NUMERATOR * x["least"][a] <= DENOMINATOR * y["most"][b]) & (
            NUMERATOR * y["least"][b] <= DENOMINATOR * x["most"][a]
        )
        keep = apart & near
        some = np.flatnonzero(keep)
        # bits all members of one node have and no member of the other
        lacks = ones(x["and"][a[some]] & ~y["or"][b[some]])
        lacked = ones(y["and"][b[some]] & ~x["or"][a[some]])
        # |u & v| is at most |u| - lacks and at most |v| - lacked; both grow with the sizes as the need does, slower
        most = np.minimum(x["most"][a[some]] - lacks, y["most"][b[some]] - lacked)
        keep[some] = most >= least_overlap(x["least"][a[some]], y["least"][b[some]])
        return keep

    def _members(self, i: int, j: int, other: Tree, mine: bool) -> np.ndarray:
        x, y = self.levels[0], other.levels[0]
        a = np.arange(x["first"][i], x["last"][i])
        b = np.arange(y["first"][j], y["last"][j])
        u, v = np.repeat(a, len(b)), np.tile(b, len(a))
        if mine:
            u, v = u[u < v], v[u < v]
        keep = self.labels[u] != other.labels[v]
        u, v = u[keep], v[keep]
        return np.column_stack([u, v])[possible(self.sizes[u], self.bits[u], other.sizes[v], other.bits[v])]


def possible(n: np.ndarray, bits: np.ndarray, m: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether two sets may be similar, by their sizes and bitmaps."""
    most = np.minimum(n - ones(bits & ~other), m - ones(other & ~bits))
    return (most >= least_overlap(n, m)) & (most > 0)
