"""From documents to packed training sequences, one operator of ``recsmith.llm`` a stage.

Each stage reads what its predecessor kept and returns the columns of
``documents``; the last returns the pieces of the packed sequences. ``run``
writes every stage's result to the shared scratch folder before the next
one reads it, so a lost executor costs no finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recsmith.llm import decontam, exact_dedup, ngram_join, packing, toxicity
from recsmith.llm.common import stored, table
from recsmith.llm.pretokens import BYTE_RANKS, default_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic (2)."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (6): that of the largest id."""
    return exact_dedup.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram join (1): that of the smallest id."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs (4)."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens (5)."""
    return packing.pack(docs, default_path(BYTE_RANKS))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot express the toxicity model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
