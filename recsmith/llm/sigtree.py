"""Signature trees over sets, and their dual traversal.

A leaf is one set: its size and a bitmap with the bit of every member set.
A node holds the OR of its children's bitmaps and the range of their sizes.
Two sets share at most the bits their bitmaps share, plus the members that
fell on an occupied bit (``spare``); a pair of nodes whose maximum possible
overlap is below what its smallest sizes need is left with all its leaves.
So is a pair whose leaves are all in one component already.

Bitmaps are as wide as the power of two from ``4 * size`` on; to be compared
the wider one is folded to the narrower one's width, which keeps the bound.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
STEP = 2048  # node pairs whose bitmaps are compared at once


def width(n: int) -> int:
    """Bytes of the bitmap of a set of ``n`` members."""
    return max(8, 1 << max(0, (4 * n - 1).bit_length() - 3))


def bitmap(members: np.ndarray) -> np.ndarray:
    """The bitmap (uint8) of a set of 64-bit hashes."""
    size = width(len(members)) * 8
    bits = np.zeros(size, bool)
    bits[(members & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of bitmaps folded to ``size`` bytes: bit i goes to bit i modulo the width."""
    if bits.shape[1] == size:
        return bits
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, size), axis=1)


def needed(a, b):
    """The least overlap o of sets of sizes a and b with 100 * o >= 75 * (a + b - o)."""
    return -(-3 * (a + b) // 7)


class Tree:
    """Leaves of one bitmap width, in the order given; levels[0] are the leaves."""

    def __init__(self, rows: np.ndarray, bits: np.ndarray, size: np.ndarray, comp: np.ndarray):
        self.rows = rows
        spare = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        level = {"bits": bits, "lo": size, "hi": size, "spare": spare, "c0": comp, "c1": comp}
        self.levels = [level]
        while len(level["lo"]) > 1:
            at = np.arange(0, len(level["lo"]), FANOUT)
            level = {"bits": np.bitwise_or.reduceat(level["bits"], at, axis=0),
                     "lo": np.minimum.reduceat(level["lo"], at), "hi": np.maximum.reduceat(level["hi"], at),
                     "spare": np.maximum.reduceat(level["spare"], at),
                     "c0": np.minimum.reduceat(level["c0"], at), "c1": np.maximum.reduceat(level["c1"], at)}
            self.levels.append(level)

    def folded(self, size: int) -> "Tree":
        if self.levels[0]["bits"].shape[1] == size:
            return self
        leaf = self.levels[0]
        return Tree(self.rows, fold(leaf["bits"], size), leaf["lo"], leaf["c0"])


def _possible(p: dict, q: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which node pairs (i of p, j of q) may hold a pair of sets that link and are not yet in one component."""
    keep = (100 * p["hi"][i] >= 75 * q["lo"][j]) & (100 * q["hi"][j] >= 75 * p["lo"][i])
    keep &= ~((p["c0"][i] == p["c1"][i]) & (q["c0"][j] == q["c1"][j]) & (p["c0"][i] == q["c0"][j]))
    at = np.flatnonzero(keep)
    least = needed(p["lo"][i[at]], q["lo"][j[at]])
    spare = np.minimum(p["spare"][i[at]], q["spare"][j[at]])
    for s in range(0, len(at), STEP):
        k = at[s:s + STEP]
        shared = np.bitwise_count(p["bits"][i[k]] & q["bits"][j[k]]).sum(axis=1, dtype=np.int64)
        keep[k] = shared + spare[s:s + STEP] >= least[s:s + STEP]
    return keep


def dual(p: Tree, q: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the leaf pairs that may link. A tree against itself gives each pair once, and no leaf with itself."""
    same = p is q
    narrow = min(p.levels[0]["bits"].shape[1], q.levels[0]["bits"].shape[1])
    p, q = p.folded(narrow), q.folded(narrow)
    a, b = len(p.levels) - 1, len(q.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        keep = _possible(p.levels[a], q.levels[b], i, j)
        i, j = i[keep], j[keep]
        if a == 0 and b == 0:
            break
        down_a, down_b = a >= b, b >= a  # the taller tree goes down first
        if down_a:
            i, j = _children(i, j, len(p.levels[a - 1]["lo"]))
            a -= 1
        if down_b:
            j, i = _children(j, i, len(q.levels[b - 1]["lo"]))
            b -= 1
        if same:
            i, j = (x[i <= j] for x in (i, j))
    if same:
        i, j = (x[i < j] for x in (i, j))
    return p.rows[i], q.rows[j]


def _children(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    own = (i[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    other = np.repeat(j, FANOUT)
    return own[own < n], other[own < n]


def candidates(bitmaps: list[bytes], size: np.ndarray, comp: np.ndarray,
               side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that may link, by trees per bitmap width; with ``side`` (0 or 1) only pairs of a 0 and a 1.

    Sets that link differ in size by a third at most, so a width meets only
    itself and the next one.
    """
    widths = np.array([len(b) for b in bitmaps])
    side = np.zeros(len(size), np.int64) if side is None else side
    trees: dict[tuple[int, int], Tree] = {}
    for w in np.unique(widths):
        for s in np.unique(side):
            rows = np.flatnonzero((widths == w) & (side == s))
            if len(rows):
                rows = rows[np.lexsort((size[rows], comp[rows]))]
                bits = np.frombuffer(b"".join(bitmaps[r] for r in rows), np.uint8).reshape(len(rows), w)
                trees[int(w), int(s)] = Tree(rows, bits, size[rows], comp[rows])
    cross = len(np.unique(side)) > 1
    out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for (w, s), tree in trees.items():
        if not cross:
            out.append(dual(tree, tree))
            if (2 * w, s) in trees:
                out.append(dual(tree, trees[2 * w, s]))
        else:
            for v in (w, 2 * w):
                if (other := trees.get((v, 1 - s))) and (v > w or s == 0):
                    out.append(dual(tree, other))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
