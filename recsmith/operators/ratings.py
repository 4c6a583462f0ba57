"""Rating facts: projections, filters, activity, export (B*, C1, D1, D12,
E1, E2, E7, H4).

Every function takes DataFrames and returns a DataFrame; thresholds are
parameters with the reference's defaults.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

# Defaults of the reference's export (fixed values).
ACTIVE_MIN_ROWS = 500
EXPORT_PER_USER = 200
RATED_QUOTA = 500


def to_als_ratings(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                   rating_col: str = "score") -> DataFrame:
    """B1: project and cast to (userId int, movieId int, rating int).

    The cast is checked (ANSI): an id outside the int range fails the job
    instead of wrapping silently, since ALS needs int ids.
    """
    return df.select(
        F.col(user_col).cast("int").alias("userId"),
        F.col(item_col).cast("int").alias("movieId"),
        F.col(rating_col).cast("int").alias("rating"),
    )


def rated_only(df: DataFrame, score_col: str = "score") -> DataFrame:
    """B2: keep rated rows (score 0 means seen but unrated)."""
    return df.filter(F.col(score_col) > 0)


def lookup_by_key(df: DataFrame, **equals) -> DataFrame:
    """Point lookup ``WHERE k1 = v1 AND ...``; pushed to the parquet scan."""
    if not equals:
        return df
    return df.filter(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in equals.items()]))


def drop_unknown_items(df: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Drop rows whose item id could not be resolved."""
    return df.filter(F.col(item_col).isNotNull())


def cold_start_filter(pred: DataFrame, train: DataFrame, user_col: str = "userId",
                      item_col: str = "movieId") -> DataFrame:
    """Keep only pairs whose user and item both occur in ``train``.

    Two semi-joins against the distinct training keys; the key sets are
    deduplicated with partial aggregation before any shuffle.
    """
    users = train.select(user_col).distinct()
    items = train.select(item_col).distinct()
    return pred.join(users, user_col, "left_semi").join(items, item_col, "left_semi")


def attach_item_ids(ratings: DataFrame, items: DataFrame, url_col: str = "item_url") -> DataFrame:
    """Resolve the catalogue id of each rating by URL (inner: unknown
    URLs are dropped, which is the intended behaviour of the export)."""
    cat = items.select(F.col(url_col), F.col("item_id"))
    return ratings.join(cat, url_col, "inner")


def active_users(ratings: DataFrame, min_rows: int = ACTIVE_MIN_ROWS, user_col: str = "user_id") -> DataFrame:
    """Users with more than ``min_rows`` rows (unrated rows count too)."""
    return (ratings.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > F.lit(min_rows)))


def limit_users(users: DataFrame, n: int, user_col: str = "user_id") -> DataFrame:
    """At most ``n`` users, lowest ids first (bounded top-n, no full sort)."""
    return users.orderBy(user_col).limit(n)


def per_key_first_n(df: DataFrame, key_cols, order_cols, n: int) -> DataFrame:
    """First ``n`` rows per key by ``order_cols``.

    ``row_number() <= n`` is planned as a WindowGroupLimit both before and
    after the shuffle, so a hot key is cut to ``n`` rows map-side.
    """
    w = Window.partitionBy(*key_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def export_ratings(ratings: DataFrame, min_rows: int = ACTIVE_MIN_ROWS, per_user: int = EXPORT_PER_USER,
                   max_users: int | None = None, items: DataFrame | None = None,
                   user_col: str = "user_id", item_col: str = "item_id", score_col: str = "score") -> DataFrame:
    """The rated rows of active users, at most ``per_user`` each.

    D1 (semi-join) -> B2 -> per-user first n by item -> optional C1 by URL.
    Output: (user_id, item_id, score).
    """
    # Count every row (unrated ones too, as D1 does) through a predicate on
    # the score that is always true: the count branch then reads the same
    # columns as the rated-rows branch, the two subtrees are identical and
    # AQE reuses one shuffle stage for both instead of scanning twice.
    every_row = F.col(score_col).isNotNull() | F.col(score_col).isNull()
    active = (ratings.groupBy(user_col).agg(F.count_if(every_row).alias("n_rows"))
              .filter(F.col("n_rows") > F.lit(min_rows)).select(user_col))
    if max_users is not None:
        active = limit_users(active, max_users, user_col)
    rated = rated_only(ratings, score_col)
    if items is not None:
        rated = attach_item_ids(rated, items)
    # The per-user limit goes first: its map-side WindowGroupLimit cuts a
    # hot user to ``per_user`` rows per partition before any shuffle, and
    # the semi-join then sees at most ``per_user`` rows per user. (Filtering
    # whole users commutes with a per-user limit.)
    picked = per_key_first_n(rated, [user_col], [F.col(item_col)], per_user).join(active, user_col, "left_semi")
    return picked.select(F.col(user_col).alias("user_id"), F.col(item_col).alias("item_id"),
                         F.col(score_col).alias("score"))


def distinct_items(ratings: DataFrame, url_col: str = "item_url", name_col: str = "item_name",
                   summary_col: str = "summary") -> DataFrame:
    """One row per URL with the lowest (name, summary).

    A hash aggregate of a struct minimum: combined map-side, so a URL
    with millions of ratings costs one row per partition in the shuffle.
    """
    best = F.min(F.struct(F.col(name_col).alias("name"), F.col(summary_col).alias("summary")))
    return ratings.groupBy(url_col).agg(best.alias("_b")).select(
        F.col(url_col).alias("item_url"), "_b.name", "_b.summary")


def first_match(df: DataFrame, key_cols, order_col: str, value_cols) -> DataFrame:
    """Per key the row with the lowest ``order_col`` (``fetchone``)."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    vals = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    best = F.min(F.struct(F.col(order_col), *[F.col(c) for c in vals]))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def split_ratings(df: DataFrame, train_fraction: float = 0.8, seed: int | None = None,
                  user_col: str = "user_id", item_col: str = "item_id", method: str = "hash"):
    """H4: 80/20 split. ``method='hash'`` is deterministic on the keys
    (``(user*31 + item*17) % 10 < 8`` for 0.8); ``'random'`` uses
    ``randomSplit`` and needs a seed."""
    if method == "random":
        if seed is None:
            raise ValueError("seed is required for a random split")
        return tuple(df.randomSplit([train_fraction, 1 - train_fraction], seed))
    cut = int(round(train_fraction * 10))
    bucket = F.pmod(F.col(user_col) * 31 + F.col(item_col) * 17, F.lit(10))
    tagged = df.withColumn("_bucket", bucket)
    return (tagged.filter(F.col("_bucket") < cut).drop("_bucket"),
            tagged.filter(F.col("_bucket") >= cut).drop("_bucket"))


def tag_split(df: DataFrame, train_fraction: float = 0.8, user_col: str = "user_id",
              item_col: str = "item_id") -> DataFrame:
    """H4 as one DataFrame with a ``part`` column ('train' / 'test')."""
    cut = int(round(train_fraction * 10))
    bucket = F.pmod(F.col(user_col) * 31 + F.col(item_col) * 17, F.lit(10))
    return df.withColumn("part", F.when(bucket < cut, F.lit("train")).otherwise(F.lit("test")))
