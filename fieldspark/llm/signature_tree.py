"""A signature tree over sets of 64-bit tokens: leaves hold a bitmap of a set's tokens and its size, inner nodes the OR
of their children's bitmaps and the range of their sizes. A self-join traverses node pairs from the root down and drops
a pair as soon as the largest overlap that its bitmaps and sizes allow cannot reach the threshold."""

from __future__ import annotations

import numpy as np

#: Bits of a bitmap: a power of two of at least four times the largest set, within these bounds.
MIN_BITS, MAX_BITS = 256, 1 << 17
#: Node pairs whose bitmaps are compared in one vector operation, times words of a bitmap.
STEP_WORDS = 1 << 18


class SignatureTree:
    def __init__(self, sets: list[np.ndarray]):
        """``sets``: sorted arrays of distinct tokens. Sets of like size stand side by side."""
        sizes = np.array([len(s) for s in sets], np.int64)
        self.order = np.argsort(sizes, kind="stable")
        bits = min(MAX_BITS, max(MIN_BITS, 1 << int(4 * max(1, sizes.max()) - 1).bit_length()))
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, i in enumerate(self.order):
            place = sets[i] & np.uint64(bits - 1)
            np.bitwise_or.at(maps[row], place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        low = sizes[self.order]
        extra = low - np.bitwise_count(maps).sum(axis=1).astype(np.int64)  # tokens that share a bit with another of their set
        self.levels = [(maps, low, low, extra)]
        while len(maps) > 1:
            odd = len(maps) % 2
            pair = lambda x, f: np.concatenate([f(x[:-1:2] if odd else x[::2], x[1::2]), x[-1:]] if odd else [f(x[::2], x[1::2])])
            maps, low, high, extra = pair(maps, np.bitwise_or), pair(low, np.minimum), pair(self.levels[-1][2], np.maximum), pair(extra, np.maximum)
            self.levels.append((maps, low, high, extra))

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs may hold sets with 100 * overlap >= percent * union."""
        maps, low, high, extra = self.levels[level]
        # sizes: the smaller set must be at least percent % of the larger
        ok = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        a, b, at = a[ok], b[ok], np.flatnonzero(ok)
        step = max(1, STEP_WORDS // maps.shape[1])
        common = np.concatenate([np.bitwise_count(maps[a[k : k + step]] & maps[b[k : k + step]]).sum(axis=1).astype(np.int64) for k in range(0, len(a), step)] or [np.zeros(0, np.int64)])
        most = np.minimum(common + np.minimum(extra[a], extra[b]), np.minimum(high[a], high[b]))
        # overlap / (|a| + |b| - overlap) >= p / 100
        fine = (100 + percent) * most >= percent * (low[a] + low[b])
        out = np.zeros(len(ok), bool)
        out[at[fine]] = True
        return out

    def candidates(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places in ``sets`` that bitmaps and sizes do not rule out, each once."""
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self._possible(level, a, b, percent)
            a, b = a[keep], b[keep]
            if level:
                n = len(self.levels[level - 1][1])
                same = a == b
                a, b = np.concatenate([2 * a, 2 * a + 1, 2 * a, 2 * a[~same] + 1]), np.concatenate([2 * b, 2 * b + 1, 2 * b + 1, 2 * b[~same]])
                inside = (a < n) & (b < n)
                a, b = a[inside], b[inside]
        leaf = a != b
        return self.order[a[leaf]], self.order[b[leaf]]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens common to two sorted arrays of distinct tokens."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Tokens common to each two of ``sets``, as a matrix: products of 0/1 matrices over a few thousand tokens each."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, ids, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1  # a token of one set alone is in no overlap
    keep = shared[ids]
    rows, ids = rows[keep], (np.cumsum(shared) - 1)[ids[keep]]
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(shared.sum()), 2048):
        a, b = np.searchsorted(ids, (low, low + 2048))
        has = np.zeros((len(sets), 2048), np.float32)
        has[rows[a:b], ids[a:b] - low] = 1
        out += has @ has.T
    return out.astype(np.int64)


def forest(sets: list[np.ndarray], percent: int, skip: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the same sets as all links do: pairs with 100 * overlap >= percent * union.

    A pair whose sets are joined by earlier links is not looked at again. ``skip``: labels; sets of one label count as
    joined from the start. Where the tree leaves many pairs a set, their overlaps are counted all at once.
    """
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, right = SignatureTree(sets).candidates(percent)
    if skip is not None:
        seen: dict = {}
        for i, label in enumerate(skip.tolist()):
            root[i] = seen.setdefault(label, i)
        apart = skip[left] != skip[right]
        left, right = left[apart], right[apart]
    checked = len(left) > 32 * len(sets)
    if checked:
        size = np.array([len(s) for s in sets])
        both = overlaps(sets)[left, right]
        linked = 100 * both >= percent * (size[left] + size[right] - both)
        left, right = left[linked], right[linked]
    out = []
    for i, j in zip(left.tolist(), right.tolist()):
        a, b = find(i), find(j)
        if a != b:
            both = 0 if checked else overlap(sets[i], sets[j])
            if checked or 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out
