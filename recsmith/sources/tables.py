"""Table scans (A3) and the stand-ins that map the driver's test tables onto
the pipeline's logical tables (users, ratings, items).

Every stand-in is a lazy DataFrame over the parquet scans, so column
pruning and filter pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the stand-in mapping (shared with the oracle SQL).
ITEM_URL_PREFIX = "https://items.example.org/subject/"
USER_URL_PREFIX = "https://people.example.org/"
STORED_BEFORE = "1997-01-01"


def table_path(sf_dir: str, name: str) -> str:
    """A table's file, or its folder of files."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """A3: one lazy scan per table."""
    return {n: table(spark, sf_dir, n) for n in (names or TABLE_NAMES)}


def table_row_counts(spark: SparkSession, sf_dir: str, names=None) -> DataFrame:
    """A3 as a query: (table_name, n_rows) per table; parquet footers answer it."""
    parts = [
        table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), "n_rows")
        for n in (names or TABLE_NAMES)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def score_expr(quantity: str = "l_quantity", flag: str = "l_returnflag"):
    """Stand-in score 0..5: returned lines are 'seen but unrated' (0)."""
    return F.when(F.col(flag) == "R", F.lit(0)).otherwise(
        F.ceil(F.col(quantity) / 10).cast("int"))


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id bigint, item_id bigint, score int, o_orderdate) — one row per
    line item, repeats included."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        score_expr().alias("score"),
        F.col("o_orderdate"),
    )


def ratings_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, score): one row per (user, item), highest score.

    The aggregation is partial before the shuffle, so a hot user does not
    land whole in one task before being reduced.
    """
    return rating_events(spark, sf_dir).groupBy("user_id", "item_id").agg(
        F.max("score").alias("score"))


def users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the users table (schema ``schemas.USERS``)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("int").alias("user_id"),
        F.col("c_name").alias("name"),
        F.pmod(F.col("c_custkey"), F.lit(80)).cast("int").alias("declared_total"),
        F.concat(F.lit(USER_URL_PREFIX), F.col("c_custkey").cast("string"), F.lit("/collect?")).alias("home_url"),
    )


def items_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the item catalogue (schema ``schemas.ITEMS``)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("summary"),
        F.concat(F.lit(ITEM_URL_PREFIX), F.col("p_partkey").cast("string"), F.lit("/")).alias("item_url"),
    )


def ratings_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the crawled ratings fact table (schema ``schemas.RATINGS``)
    plus ``o_orderdate`` for the 'already stored' split. Repeats kept."""
    ev = rating_events(spark, sf_dir)
    items = items_table(spark, sf_dir).select(
        F.col("item_id").alias("i_id"), F.col("name").alias("item_name"), "summary", "item_url")
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("u_id"), F.col("c_name").alias("user_name"))
    return (
        ev.join(items, ev.item_id == items.i_id)
        .join(users, ev.user_id == users.u_id)
        .select(
            "item_name", "summary",
            F.col("user_id").cast("int").alias("user_id"),
            "user_name", "score", "item_url", "o_orderdate",
        )
    )


def stored_before(date_col: str = "o_orderdate"):
    """Stand-in split: facts from orders before 1997 are 'already stored',
    the later ones form the new batch."""
    return F.col(date_col) < F.lit(STORED_BEFORE).cast("timestamp_ntz")
