"""Fixed table schemas (A10) and their validation.

The stored tables of the rating pipeline. Every data column is NOT NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

USERS = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("declared_total", T.IntegerType(), False),
    T.StructField("home_url", T.StringType(), False),
])

RATINGS = T.StructType([
    T.StructField("item_name", T.StringType(), False),
    T.StructField("summary", T.StringType(), False),
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("user_name", T.StringType(), False),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("item_url", T.StringType(), False),
])

ITEMS = T.StructType([
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("summary", T.StringType(), False),
    T.StructField("item_url", T.StringType(), False),
])

USER_RECS = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("item_ids", T.ArrayType(T.IntegerType(), False), False),
])

ITEM_RECS = T.StructType([
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("neighbour_ids", T.ArrayType(T.IntegerType(), False), False),
])

ALS_RATINGS = T.StructType([
    T.StructField("userId", T.IntegerType(), False),
    T.StructField("movieId", T.IntegerType(), False),
    T.StructField("rating", T.IntegerType(), False),
])

TABLES = {
    "users": USERS,
    "ratings": RATINGS,
    "items": ITEMS,
    "user_recs": USER_RECS,
    "item_recs": ITEM_RECS,
}


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per non-nullable column the number of nulls (A10).

    A single pass with partial aggregation; nothing is collected.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for schema: {missing}")
    aggs = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in required]
    aggs.append(F.count(F.lit(1)).alias("n_rows"))
    return df.agg(*aggs)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; the rows that ``rejects`` gives are left out."""
    return _cast(df, schema).filter(_complete(schema))


def rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that ``conform`` leaves out: null in a required column, or not
    readable as its type. Cast to ``schema``."""
    return _cast(df, schema).filter(~_complete(schema))


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _complete(schema: T.StructType):
    required = [F.col(f.name).isNotNull() for f in schema.fields if not f.nullable]
    return reduce(lambda a, b: a & b, required, F.lit(True))


def validate_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A10: one row of null-violation counts per required column (and the
    row count); all zero means ``df`` can be stored under ``schema``."""
    return null_violations(df, schema)
