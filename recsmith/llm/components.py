"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import stored

TASK_EDGES = 500_000


def _local_forest(edges: DataFrame) -> DataFrame:
    """Each task replaces its own edges by stars around the least node of each of their components."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def find(x):
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while (up := parent[x]) != root:
                parent[x] = root
                x = up
            return root

        for pdf in batches:
            for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
                ra, rb = find(a), find(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
        rows = [(root, x) for x in list(parent) if (root := find(x)) != x]
        yield pd.DataFrame(rows, columns=["a", "b"], dtype="int64")

    return edges.mapInPandas(run, "a long, b long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): every node of ``edges(a, b)`` with the least node of its component.

    The edges are dealt to tasks of ``TASK_EDGES`` or so by the hash of the
    whole edge, so a large component takes many; each merges what it holds. While there are several tasks, large-star and small-star steps
    alternate with that until no edge changes, a number of rounds that grows
    with the logarithm of the node count at most. Each round is written out,
    so no lineage grows and a lost executor costs one round at most.
    """
    cur = stored(edges.select("a", "b").where("a <> b").distinct(), name)
    seen = _digest(cur)
    tasks = -(-seen[0] // TASK_EDGES)
    if tasks <= 1:
        return _rooted(stored(_local_forest(cur.coalesce(1)), name))
    while True:
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a AND m <> b").select(F.col("m").alias("a"), "b")  # (smaller, larger)
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        cur = stored(_local_forest(small.where("a <> b").repartition(tasks, "a", "b")).distinct(), name)
        if (now := _digest(cur)) == seen:
            return _rooted(cur)
        seen = now


def _rooted(stars: DataFrame) -> DataFrame:
    own = stars.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).union(own)


def _digest(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
