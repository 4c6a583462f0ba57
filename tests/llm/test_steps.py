"""Stored steps leave no shuffle files; nodes that hold several components."""

import time

from pyspark.sql import functions as F

from recsmith.llm import setunits
from recsmith.llm.common import stored


def _shuffles(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split() if b.startswith("shuffle")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    """op1: files of all steps before lay on disk until the driver collected its garbage."""
    before = _shuffles(spark)
    df = stored(spark.range(10_000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "step")
    until = time.time() + 20
    while _shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffles(spark) - before
    assert {r.k for r in df.collect()} == set(range(7))


def test_rows_of_mixed_nodes(spark, monkeypatch):
    """op12_chosen_path: only the rows of nodes of several parts are joined with their node's size."""
    monkeypatch.setattr(setunits, "UNIT_ROWS", 2)
    rows = spark.createDataFrame([(1, f, 5, 9 + f) for f in (1, 2, 3)] + [(2, f, 5, 8) for f in (4, 5)]
                                 + [(3, f, 5, 8) for f in (1, 2)], "node long, fp long, n long, above long")
    comp = spark.createDataFrame([(1, 1), (2, 1)], "fp long, comp long")
    got = {(r.node, r.fp, r.comp, r.k, r.parts, r.above) for r in setunits.mixed(rows, comp, "above", apart=True).collect()}
    assert got == {(1, 1, 1, 3, 2, 12), (1, 2, 1, 3, 2, 12), (1, 3, 3, 3, 2, 12), (2, 4, 4, None, 1, None),
                   (2, 5, 5, None, 1, None)}
