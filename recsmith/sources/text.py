"""Line-oriented text sources and sinks (A1, A2, A4, A5).

Rating lines are ``user::item::score``; seed lines are ``url name``.
Readers return typed DataFrames straight from ``spark.read.text`` (no RDD
hop, no schema inference); writers append text files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as X


def parse_rating_lines(lines: DataFrame, value_col: str = "value", keep_bad: bool = False) -> DataFrame:
    """A1 on a DataFrame of lines -> (userId, movieId, rating) ints.

    A line with fewer than three fields, or a field that is not an int
    (e.g. ``None`` for an unknown item), is dropped; with ``keep_bad`` it
    is kept with nulls and ``ok = false``.
    """
    parts = X.split_fields(F.col(value_col), "::")
    out = lines.select(
        X.to_int(F.get(parts, 0)).alias("userId"),
        X.to_int(F.get(parts, 1)).alias("movieId"),
        X.to_int(F.get(parts, 2)).alias("rating"),
    )
    ok = F.col("userId").isNotNull() & F.col("movieId").isNotNull() & F.col("rating").isNotNull()
    if keep_bad:
        return out.withColumn("ok", ok)
    return out.filter(ok)


def parse_ratings_text(spark: SparkSession, path: str, keep_bad: bool = False) -> DataFrame:
    """A1: scan rating text files."""
    return parse_rating_lines(spark.read.text(path), keep_bad=keep_bad)


def format_rating_lines(df: DataFrame, user_col: str = "userId", item_col: str = "movieId",
                        rating_col: str = "rating") -> DataFrame:
    """A4: (user, item, score) -> ``value = 'u::i::s'``."""
    return df.select(F.concat_ws("::", F.col(user_col).cast("string"), F.col(item_col).cast("string"),
                                 F.col(rating_col).cast("string")).alias("value"))


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """A4/A5 sink: append the ``value`` column as text files."""
    df.select("value").write.mode(mode).text(path)


def parse_seed_lines(lines: DataFrame, value_col: str = "value", dedup: bool = True) -> DataFrame:
    """A2 on lines -> (url, name): first two blank-separated tokens.

    Empty lines are dropped; with ``dedup`` one row per URL (lowest name)
    remains, since the same line can occur several times.
    """
    tok = X.split_whitespace(F.col(value_col))
    out = (lines.select(F.get(tok, 0).alias("url"), F.get(tok, 1).alias("name"))
           .filter((F.col("url").isNotNull()) & (F.col("url") != "")))
    if dedup:
        out = out.groupBy("url").agg(F.min("name").alias("name"))
    return out


def parse_seed_list(spark: SparkSession, path: str, dedup: bool = True) -> DataFrame:
    """A2: scan seed-list text files."""
    return parse_seed_lines(spark.read.text(path), dedup=dedup)


def format_seed_lines(df: DataFrame, url_col: str = "collect_url", name_col: str = "user_name") -> DataFrame:
    """A5: (url, name) -> ``value = 'url name'``."""
    return df.select(F.concat_ws(" ", F.col(url_col), F.col(name_col)).alias("value"))


def format_ratings_text(df: DataFrame, path: str, **cols) -> None:
    """A4: append (user, item, score) rows as ``u::i::s`` lines."""
    write_lines(format_rating_lines(df, **cols), path, mode="append")


def format_seed_list(df: DataFrame, path: str, **cols) -> None:
    """A5: append (collect url, name) rows as ``url name`` lines."""
    write_lines(format_seed_lines(df, **cols), path, mode="append")
