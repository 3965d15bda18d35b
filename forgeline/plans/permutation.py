"""Permuted features (M16): what a forest says of a row for every bin of one feature, and the rows that lend their values.

A forest sees of a value only which of its cuts lie below.  So a row's hits with one feature replaced are worked out once
for each bin of that feature, a bit each, and a repeat only looks up the bin of the row that it takes the value from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
TIE = 1e-9                      # classes nearer than this are compared by the forest's own sums


# --- the permutation of ``ml.permuted``, over arrays -------------------------------------------
def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * P2
    x = (x ^ (x >> np.uint64(29))) * P3
    return x ^ (x >> np.uint64(32))


def _hash_long(value: np.ndarray, seed) -> np.ndarray:
    return _mixed(_rotated((seed + P5 + np.uint64(8)) ^ (_rotated(value.astype(np.uint64) * P2, 31) * P1), 27) * P1 + P4)


def _hash_int(value: int, seed) -> np.ndarray:
    return _mixed(_rotated((seed + P5 + np.uint64(4)) ^ (np.uint64(value & 0xFFFFFFFF) * P1), 23) * P2 + P3)


def permuted(position: np.ndarray, n: int, *key: int, rounds: int = 4, walks: int = 64) -> np.ndarray:
    """``ml.permuted`` of long positions and int keys, with Spark's xxhash64."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def hashed(half: np.ndarray, r: int, size: int) -> np.ndarray:
        h = _hash_long(half, np.uint64(42))
        for k in (r, *key):
            h = _hash_int(k, h)
        return np.mod(h.view(np.int64), size)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x // b, x % b
        for r in range(rounds):
            if r % 2 == 0:
                left = (left + hashed(right, r, a)) % a
            else:
                right = (right + hashed(left, r, b)) % b
        return left * b + right

    with np.errstate(over="ignore"):
        image = once(position.astype(np.int64))
        for _ in range(min(a, walks) - 1):
            if not (out := image >= n).any():
                break
            image[out] = once(image[out])
    if (image >= n).any():
        raise ValueError("a permutation's walk did not end")
    return image


# --- hits for every bin --------------------------------------------------------------------------
class Bins:
    """The cuts of a forest, feature by feature, and its nodes with their cut as a number."""

    def __init__(self, forest):
        self.forest = forest
        self.inner = forest.child[::2] != np.arange(len(forest.feature))
        self.cuts = [np.unique(forest.cut[self.inner & (forest.feature == i)]) for i in range(len(forest.features))]
        self.cut = np.zeros(len(forest.feature), np.int64)
        for i, c in enumerate(self.cuts):
            at = self.inner & (forest.feature == i)
            self.cut[at] = np.searchsorted(c, forest.cut[at])
        self.left, self.right = forest.child[::2].tolist(), forest.child[1::2].tolist()
        self.ends, self.tested, self.at = (~self.inner).tolist(), forest.feature.tolist(), self.cut.tolist()
        # of each feature: the nodes that test it first on their path, and the cuts on it below them
        self.first: list[list[tuple[int, list[int]]]] = [[] for _ in forest.features]
        for root in forest.roots.tolist():
            self._walk(root, frozenset())

    def _walk(self, node: int, met: frozenset) -> dict[int, set[int]]:
        if self.ends[node]:
            return {}
        f = self.tested[node]
        below: dict[int, set[int]] = {f: {self.at[node]}}
        for child in (self.left[node], self.right[node]):
            for g, cuts in self._walk(child, met | {f}).items():
                below.setdefault(g, set()).update(cuts)
        if f not in met:
            self.first[f].append((node, sorted(below[f])))
        return below

    def of(self, x: np.ndarray) -> list[np.ndarray]:
        """Columns of bins of imputed rows: how many cuts lie below each value."""
        return [np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(self.cuts)]

    def value(self, feature: int, bin_: np.ndarray) -> np.ndarray:
        """A value of each bin."""
        return np.append(self.cuts[feature], np.inf)[bin_]

    def _reach(self, node: int, rows: np.ndarray, columns, reached: dict[int, np.ndarray], leaf: np.ndarray) -> None:
        reached[node] = rows
        if self.ends[node]:
            leaf[rows] = node
        elif len(rows):
            right = columns[self.tested[node]][rows] > self.at[node]
            self._reach(self.left[node], rows[~right], columns, reached, leaf)
            self._reach(self.right[node], rows[right], columns, reached, leaf)

    def _leaves(self, node: int, rows: np.ndarray, columns, feature: int, bin_: int) -> Iterator[tuple[int, np.ndarray]]:
        """The leaves of the rows from ``node`` on, with ``feature`` in ``bin_``."""
        while not self.ends[node] and self.tested[node] == feature:
            node = self.right[node] if bin_ > self.at[node] else self.left[node]
        if self.ends[node]:
            yield node, rows
        elif len(rows):
            right = columns[self.tested[node]][rows] > self.at[node]
            yield from self._leaves(self.left[node], rows[~right], columns, feature, bin_)
            yield from self._leaves(self.right[node], rows[right], columns, feature, bin_)

    def hits(self, x: np.ndarray, true: np.ndarray, in_top) -> Iterator[tuple[int, np.ndarray]]:
        """(feature, (rows, bins) whether the true class is in the top) of imputed rows, for ``in_top(probabilities, true)``.

        Sums of leaf shares are carried from bin to bin; where classes come within ``TIE``, the forest's own sums decide.
        """
        forest, columns, n = self.forest, self.of(x), len(x)
        reached: dict[int, np.ndarray] = {}
        base = np.zeros((n, forest.share.shape[1]))
        of_leaf = []
        for root in forest.roots.tolist():
            leaf = np.zeros(n, np.int64)
            self._reach(root, np.arange(n), columns, reached, leaf)
            base += forest.share[leaf]
            of_leaf.append(leaf)
        of_node = np.searchsorted(forest.roots, np.arange(len(forest.feature)), side="right") - 1
        mine = np.where(true < base.shape[1], true, 0)
        for f, firsts in enumerate(self.first):
            bins = len(self.cuts[f]) + 1
            change = np.zeros((bins + 1, n, base.shape[1]))
            change[0] = base
            for node, cuts in firsts:
                rows = reached.get(node)
                if rows is None or not len(rows):
                    continue
                leaf = of_leaf[of_node[node]]
                for lo, hi in zip([0, *(c + 1 for c in cuts)], [*(c + 1 for c in cuts), bins]):
                    for end, some in self._leaves(node, rows, columns, f, lo):
                        some = some[leaf[some] != end]
                        if len(some):
                            delta = forest.share[end] - forest.share[leaf[some]]
                            change[lo, some] += delta
                            change[hi, some] -= delta
            hit = np.empty((n, bins), bool)
            votes = np.zeros_like(base)
            for b in range(bins):
                votes += change[b]
                away = votes - votes[np.arange(n), mine][:, None]
                hit[:, b] = in_top(away, true)
                near = (np.abs(away) < TIE).sum(axis=1) > 1
                if near.any():
                    varied = x[near]
                    varied[:, f] = self.value(f, np.full(len(varied), b))
                    hit[near, b] = in_top(forest.predict(varied), true[near])
            yield f, hit
