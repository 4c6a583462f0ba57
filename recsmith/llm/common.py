"""Registry, scratch tables and small column helpers of the package."""

from __future__ import annotations

import pickle
import string
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import written

BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; ``sql`` is its DuckDB oracle, if SQL can express it."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor loses no part of it. The folder goes
    when the application ends. Python workers get their rows in batches of
    ``BATCH_BYTES`` meanwhile, since rows hold texts and sets of any length.
    """
    spark = df.sparkSession
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, BATCH_BYTES)
    try:
        return written(df, name)
    finally:
        spark.conf.set(BATCH_CONF, before)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same on pure ASCII and is much faster there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, equals ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % mod == remainder, F.lit(False))


def fitted(sample: DataFrame, fit: Callable[[pd.DataFrame], object]):
    """``fit`` of a sample of bounded size, in one task; the model comes back to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [*batches]
        yield pd.DataFrame({"model": [pickle.dumps(fit(pd.concat(rows) if rows else empty))]})

    empty = pd.DataFrame({c: [] for c in sample.columns})
    got = sample.repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(got["model"]) if got else fit(empty)
