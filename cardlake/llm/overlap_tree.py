"""R-tree of count vectors that bounds how much two token sets can overlap.

A set's tokens are hashed into ``GROUPS`` groups; the vector of group counts is
its point.  |A & B| is at most the sum over the groups of min(a_g, b_g).  A box
has the largest count of each group among its points, so the same sum with the box
in place of b bounds every point inside; with the smallest set size in the box
that tells whether any of them can reach the similarity.  A search goes down
from the root level by level with all its queries side by side and compares
single points only in the leaves that remain.
"""

from __future__ import annotations

import numpy as np

GROUPS = 256
FANOUT = 16
PAIRS = 1 << 12  # pairs whose minima are summed at a time


def count_vector(hashes: np.ndarray) -> bytes:
    """Group counts of a set of 64-bit hashes: 1 byte a group, 2 or 4 if one needs them."""
    counts = np.bincount((hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    return counts.astype(np.min_scalar_type(counts.max())).tobytes()


def as_matrix(vectors: list[bytes]) -> np.ndarray:
    kinds = {GROUPS: np.uint8, 2 * GROUPS: np.uint16, 4 * GROUPS: np.uint32}
    return np.array([np.frombuffer(v, kinds[len(v)]) for v in vectors], np.int32).reshape(-1, GROUPS)


def bitmap(hashes: np.ndarray) -> bytes:
    """A set of 64-bit hashes as a bitmap, of a power of two of bits from twice the set's size on."""
    bits = 1 << max(6, int(2 * len(hashes) - 1).bit_length())
    out = np.zeros(bits, bool)
    out[(hashes >> np.uint64(8)) & np.uint64(bits - 1)] = True
    return np.packbits(out, bitorder="little").tobytes()


class Bitmaps:
    """Bitmaps of sets, that bound the overlap of two sets of about one size far closer than group counts.

    A bit of one set that the other has not stands for at least one hash that the other has not.
    Bitmaps of two lengths are compared at the smaller one, the larger folded onto it.
    """

    def __init__(self, maps, size: np.ndarray):
        self.maps, self.size, self.tables = maps, size.astype(np.int64), {}
        self.bits = np.array([len(m) for m in maps], np.int64)

    def table(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The place of each bitmap in a matrix of those of ``length`` bytes or more, and the matrix."""
        if length not in self.tables:
            place, rows = np.full(len(self.bits), -1), []
            # more than twice as long is more than 4/3 times as large
            for i in np.flatnonzero((self.bits >= length) & (self.bits <= 2 * length)):
                place[i] = len(rows)
                words = np.frombuffer(self.maps[i], np.uint64)
                rows.append(words if len(words) * 8 == length else words[:length // 8] | words[length // 8:])
            self.tables[length] = place, np.array(rows, np.uint64).reshape(len(rows), length // 8)
        return self.tables[length]

    def bound(self, others: "Bitmaps", i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The most that others[i] and self[j] can have in common, pair by pair."""
        out = np.minimum(others.size[i], self.size[j])
        length = np.minimum(others.bits[i], self.bits[j])
        near = np.maximum(others.bits[i], self.bits[j]) <= 2 * length
        for one in np.unique(length[near]):
            (at, x), (at2, y) = others.table(int(one)), self.table(int(one))
            pick = np.flatnonzero(near & (length == one))
            step = max(1, (PAIRS * GROUPS) // int(one))
            for k in range(0, len(pick), step):
                q = pick[k:k + step]
                a, b = x[at[i[q]]], y[at2[j[q]]]
                both = np.bitwise_count(a & b).sum(1, dtype=np.int64)
                out[q] = np.minimum(out[q], both + np.minimum(
                    others.size[i[q]] - np.bitwise_count(a).sum(1, dtype=np.int64),
                    self.size[j[q]] - np.bitwise_count(b).sum(1, dtype=np.int64)))
        return out


def _minima(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Summed minima of x[i] and y[j], pair by pair."""
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), PAIRS):
        out[k:k + PAIRS] = np.minimum(x[i[k:k + PAIRS]], y[j[k:k + PAIRS]]).sum(1)
    return out


class Tree:
    """Points of up to a few thousand sets: counts, set sizes, and a class that isn't to be met again."""

    def __init__(self, counts: np.ndarray, size: np.ndarray, own: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        # neighbours of a class and of a size make tight boxes
        self.order = np.lexsort((size, own))
        at = self.order
        self.levels = [(counts[at], size[at], size[at], own[at], own[at])]
        while len(self.levels[-1][0]) > FANOUT:
            box, least, most, first, last = self.levels[-1]
            start = np.arange(0, len(box), FANOUT)
            self.levels.append((np.maximum.reduceat(box, start), np.minimum.reduceat(least, start),
                                np.maximum.reduceat(most, start), np.minimum.reduceat(first, start),
                                np.maximum.reduceat(last, start)))

    def search(self, counts: np.ndarray, size: np.ndarray, own: np.ndarray) -> tuple:
        """(query, point, bound) of all pairs of different classes whose bound allows the similarity."""
        top = len(self.levels[-1][0])
        i, j = np.repeat(np.arange(len(counts)), top), np.tile(np.arange(top), len(counts))
        for level in range(len(self.levels) - 1, -1, -1):
            box, least, most, first, last = self.levels[level]
            n = size[i]
            # the smaller set is at least num / den of the larger one, and the classes differ
            fits = ((self.den * most[j] >= self.num * n) & (self.den * n >= self.num * least[j])
                    & ~((first[j] == own[i]) & (last[j] == own[i])))
            i, j = i[fits], j[fits]
            bound = _minima(counts, i, box, j)
            fits = bound * (self.num + self.den) >= self.num * (size[i] + least[j])
            i, j, bound = i[fits], j[fits], bound[fits]
            if level:
                below = len(self.levels[level - 1][0])
                i, j = np.repeat(i, FANOUT), (j[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                i, j = i[j < below], j[j < below]
        return i, self.order[j], bound


def best_of_each(i: np.ndarray, j: np.ndarray, bound: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Places of the pairs that come closest to equality, one for each query in ``i``."""
    order = np.lexsort((j, -bound / (size[i] + other[j]), i))
    first = np.concatenate(([True], i[order][1:] != i[order][:-1])) if len(order) else order.astype(bool)
    return order[first]
