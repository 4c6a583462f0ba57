"""Exact comparison of sets inside units of bounded size.

A unit is a run of rows (node, p, q, side) that one task compares as a
whole: all pairs if it has one side, else the pairs of the two sides. Two
steps, both in bounded memory:

1. bitmaps: a row goes on if some row of another component may link with it,
   by the bits their bitmaps share plus the members that fell on occupied
   bits (no link is lost), or by another test that loses none;
2. full sets of the rows left: the overlap of all their pairs at once, as a
   product of the incidence matrix of the shingles that two or more hold.

No pairs are handed on: a unit answers with one edge per component that it
found linked to another one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .components import components

UNIT_ROWS = 512  # rows of one side of a unit
UNIT_MEMBERS = 1 << 21  # members of their sets
DENSITY = 4  # bits of a bitmap for each member
BLOCK_BYTES = 1 << 24  # of intermediate comparisons
COLUMNS = 2048  # of the incidence matrix at once
BROADCAST_ROWS = 1_000_000  # set ids sent to all tasks, at most: 8 MB
KEY = ["node", "p", "q"]
GROUP = [*KEY, "grp"]


def bitmap(members: np.ndarray) -> bytes:
    """The bitmap of a set of 64-bit hashes; its width is a power of two, 8 bytes or more."""
    bits = np.zeros(max(64, 1 << (DENSITY * len(members) - 1).bit_length()), bool)
    bits[(members & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def parts(rows, members):
    """Column: the parts that a node of so many rows and members is cut into."""
    return F.greatest(F.ceil(rows / UNIT_ROWS), F.ceil(members / UNIT_MEMBERS)).cast("int")


def may_link(bitmaps: np.ndarray, size: np.ndarray, comp: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """The group of each row, -1 for none: the rows joined by pairs of different components, and of different sides if
    there are two, that may link."""
    pairs = []
    cross = side.min() != side.max()
    widths = np.array([len(b) for b in bitmaps])
    own = {int(w): np.flatnonzero(widths == w) for w in np.unique(widths)}
    bits = {w: np.frombuffer(b"".join(bitmaps[r] for r in rows), np.uint64).reshape(len(rows), -1)
            for w, rows in own.items()}
    for w, rows in own.items():
        v = w
        while v in own and (v == w or percent * size[own[v]].min() <= 100 * size[rows].max()):
            a, b, others = bits[w], bits[v], own[v]
            if v > w:  # bit i goes to bit i modulo the narrower width
                b = np.bitwise_or.reduce(b.reshape(len(b), v // w, -1), axis=1)
            spare_a = size[rows] - np.bitwise_count(a).sum(axis=1, dtype=np.int64)
            spare_b = size[others] - np.bitwise_count(b).sum(axis=1, dtype=np.int64)
            step = max(1, BLOCK_BYTES // (len(b) * w))
            for s in range(0, len(rows), step):
                i = rows[s:s + step]
                shared = np.zeros((len(i), len(others)), np.int64)
                for k in range(0, a.shape[1], 64):
                    shared += np.bitwise_count(a[s:s + step, None, k:k + 64] & b[None, :, k:k + 64]).sum(
                        axis=2, dtype=np.int64)
                shared += np.minimum(spare_a[s:s + step, None], spare_b[None])
                np.minimum(shared, np.minimum(size[i][:, None], size[others][None]), out=shared)
                ok = (100 + percent) * shared >= percent * (size[i][:, None] + size[others][None])
                ok &= comp[i][:, None] != comp[others][None]
                if cross:
                    ok &= side[i][:, None] != side[others][None]
                x, y = np.nonzero(ok)
                pairs.append((i[x], others[y]))
            v *= 2
    return grouped(len(size), *(np.concatenate([p[k] for p in pairs]) for k in (0, 1)))


def grouped(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels 0 .. n - 1 of the rows that the pairs (i, j) connect, -1 for rows in no pair."""
    label = np.arange(n)
    while len(i):
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    alone = np.ones(n, bool)
    alone[i] = alone[j] = False
    return np.where(alone, -1, label)


def overlaps(members: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs of sorted distinct members, exact but for the diagonal."""
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    values = np.concatenate(members)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    shared = np.diff(np.append(np.flatnonzero(new), len(values))) > 1
    code = np.cumsum(new) - 1
    take = shared[code]
    code, owner = (np.cumsum(shared) - 1)[code[take]], owner[take]
    out = np.zeros((len(members), len(members)), np.int64)
    n = int(code[-1]) + 1 if len(code) else 0
    for c in range(0, n, COLUMNS):
        lo, hi = np.searchsorted(code, [c, c + COLUMNS])
        x = np.zeros((len(members), min(COLUMNS, n - c)), np.float32)
        x[owner[lo:hi], code[lo:hi] - c] = 1
        out += (x @ x.T).astype(np.int64)
    return out


def linked_components(members: list[np.ndarray], comp: np.ndarray, side: np.ndarray,
                      percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b): of the components that the rows' links join, the least and each other one."""
    size = np.array([len(m) for m in members])
    shared = overlaps(members)
    link = (100 + percent) * shared >= percent * (size[:, None] + size[None])
    if side.min() != side.max():
        link &= side[:, None] != side[None]
    kinds, label = np.unique(comp, return_inverse=True)
    own = label.copy()
    while True:  # the least label of each linked group
        low = np.minimum(own, np.where(link, own[None], len(kinds)).min(axis=1))
        least = np.full(len(kinds), len(kinds))
        np.minimum.at(least, label, low)
        least = least[label]
        if (least == own).all():
            break
        own = least
    pairs = np.unique(np.stack([own, label], axis=1)[own != label], axis=0)
    return kinds[pairs[:, 0]], kinds[pairs[:, 1]]


def _units(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of whole units of sorted batches, one unit at a time."""
    held = None
    for pdf in batches:
        cols = {c: pdf[c].to_numpy() for c in pdf.columns}
        if held is not None:
            cols = {c: np.concatenate([held[c], x]) for c, x in cols.items()}
        key = np.stack([cols[c] for c in by])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        edges = [0, *cut.tolist()]
        for s, e in zip(edges[:-1], edges[1:]):
            yield {c: x[s:e] for c, x in cols.items()}
        held = {c: x[edges[-1]:] for c, x in cols.items()}
    if held is not None and len(held["node"]):
        yield held


def _frames(parts: Iterator[dict[str, np.ndarray]], columns: list[str]) -> Iterator[pd.DataFrame]:
    """The parts put together to frames of some thousand rows."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[columns[0]])
        if size >= 8192:
            yield pd.DataFrame({c: np.concatenate([x[c] for x in held]) for c in columns})
            held, size = [], 0
    if held:
        yield pd.DataFrame({c: np.concatenate([x[c] for x in held]) for c in columns})


def among(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose ``fp`` is in ``rows``; where these are counted as few, before any shuffle."""
    some = rows.select("fp").distinct()
    return sets.join(F.broadcast(some) if some.count() <= BROADCAST_ROWS else some, "fp", "left_semi")


def candidates(rows: DataFrame, sig: DataFrame, percent: int, test=may_link) -> DataFrame:
    """(node, p, q, grp, side, fp, comp): the rows of ``rows(node, p, q, side, fp, comp)`` that may link in their unit,
    by groups that possible links connect; ``sig`` is (fp, n, sig)."""
    columns = [*KEY, "side", "fp", "comp"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found():
            for unit in _units(batches, KEY):
                grp = test(unit["sig"], unit["n"], unit["comp"], unit["side"], percent)
                hit = grp >= 0
                if hit.any():
                    yield {c: unit[c][hit] for c in columns} | {"grp": grp[hit]}

        yield from _frames(found(), [*GROUP, *columns[len(KEY):]])

    units = rows.join(sig, "fp").select(*columns, "n", "sig")
    return units.repartition(*KEY).sortWithinPartitions(*KEY).mapInPandas(
        run, "node long, p int, q int, grp int, side int, fp long, comp long")


def edges(found: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(a, b): components that links of ``found``, the candidates of units, join; ``full`` is (fp, members)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def joins():
            for unit in _units(batches, GROUP):
                members = [np.frombuffer(m, np.uint64) for m in unit["members"]]
                a, b = linked_components(members, unit["comp"], unit["side"], percent)
                if len(a):
                    yield {"a": a, "b": b}

        yield from _frames(joins(), ["a", "b"])

    # Sets that link mostly meet in several units: one of the groups that hold the same is enough.
    own = [F.bit_xor(F.xxhash64("fp", "side", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    groups = found.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("c"), *own)
    groups = groups.groupBy("c", "x1", "x2").agg(F.min(F.struct(*GROUP)).alias("g")).select("g.*")
    units = found.join(groups, GROUP, "left_semi")
    units = units.join(among(full, found).dropDuplicates(["fp"]), "fp").select(*GROUP, "side", "comp", "members")
    return units.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(run, "a long, b long").distinct()


def own_parts(rows: DataFrame, turn: int) -> DataFrame:
    """Units of each node's rows, dealt to its ``parts`` in an order drawn for ``turn``."""
    p = F.pmod(F.xxhash64("fp", "node", F.lit(turn)), F.col("parts")).cast("int")
    return rows.select("node", p.alias("p"), p.alias("q"), F.lit(0).alias("side"), "fp", "comp")


def all_parts(rows: DataFrame) -> DataFrame:
    """Units for all pairs of rows of different components of each node of ``rows(node, fp, n, comp)``.

    The rows of a node's greatest component meet the others only, never each other.
    """
    size = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    size = size.groupBy("node").agg(F.max(F.struct("k", "s", "comp")).alias("top"), F.sum("k").alias("k"),
                                    F.sum("s").alias("s"))
    size = size.select("node", F.col("top.comp").alias("main"),
                       F.greatest(parts(F.col("top.k"), F.col("top.s")), F.lit(1)).alias("mains"),
                       F.greatest(parts(F.col("k") - F.col("top.k"), F.col("s") - F.col("top.s")),
                                  F.lit(1)).alias("others"))
    rows = rows.select("node", "fp", "comp").join(size, "node")
    is_main = F.col("comp") == F.col("main")
    # Parts 0 .. others - 1 hold the others, the next ones the greatest component.
    p = F.when(is_main, F.col("others") + F.pmod(F.xxhash64("fp"), F.col("mains"))).otherwise(
        F.pmod(F.xxhash64("fp"), F.col("others"))).cast("int")
    last = F.when(is_main, F.col("others") - 1).otherwise(F.col("others") + F.col("mains") - 1)
    rows = rows.select("node", "fp", "comp", p.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    return rows.select("node", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "comp")


def mixed(rows: DataFrame, comp: DataFrame | None, *also: str, apart: bool = False) -> DataFrame:
    """(node, fp, n, comp, k, parts): the rows of nodes that hold several components of ``comp(fp, comp)``, with the
    maxima of the columns ``also``. With ``apart``, rows of nodes of one part are only told from others, without a join
    that makes rows: their k and maxima are null."""
    if comp is None:
        rows = rows.select("node", "fp", "n", F.col("fp").alias("comp"), *also)
    else:
        rows = rows.select("node", "fp", "n", *also).join(comp, "fp", "left").select(
            "node", "fp", "n", F.coalesce("comp", "fp").alias("comp"), *also)
    nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"), F.min("comp").alias("c0"),
                                     F.max("comp").alias("c1"), *(F.max(c).alias(c) for c in also)).where("c0 <> c1")
    nodes = nodes.select("node", "k", parts(F.col("k"), F.col("s")).alias("parts"), *also)
    rows = rows.select("node", "fp", "n", "comp")
    if not apart:
        return rows.join(nodes, "node")
    large = rows.join(nodes.where("parts > 1"), "node")
    small = rows.join(nodes.where("parts <= 1"), "node", "left_semi")
    return large.unionByName(small.withColumn("parts", F.lit(1)), allowMissingColumns=True)


def merged(comp: DataFrame | None, found: DataFrame) -> DataFrame:
    """(fp, comp) after the edges ``found`` between components."""
    if comp is not None:
        found = comp.where("fp <> comp").select(F.col("comp").alias("a"), F.col("fp").alias("b")).union(found)
    return components(found).select(F.col("node").alias("fp"), F.col("root").alias("comp"))
