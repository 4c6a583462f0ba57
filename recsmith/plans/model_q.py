"""Registered queries: ALS.

SQL cannot run ALS, but it can tell what must hold of its output. Each
query runs its operator over all rated pairs with the main run's settings
and returns the output's keys with what was checked of each. Lists must hold the
top n of the full product of the factors: the list of the blocked product of all
and that of the bounded one are told apart by how they are found only, so the
score of every listed id, recomputed from the factors, must be the one the
other way found at its rank. ``RAW`` has the outputs themselves.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import evaluate as E, model as M, ratings as R, serve as V
from ..operators.similarity import cosine
from ..session import scratch_path, written
from ..sources import store as ST, tables as T
from .evaluation_q import SPLIT
from .oracle import RATING_EVENTS, RATINGS_BASE, with_
from .refresh import refresh_rec_lists
from .registry import query
from .serving_q import OLD_I, OLD_U, item_lists, user_lists

SEED = 42
TITLES = 10
CHECKED = 12_000_000  # ratings whose items' factors are sent to their users at once, about 2 GB

RATED = RATINGS_BASE + """,
rated AS (SELECT * FROM ratings_base WHERE score > 0),
n AS (SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM rated)"""


def als_input(spark, d) -> DataFrame:
    """All rated pairs."""
    return R.to_als_ratings(R.rated_only(T.ratings_base(spark, d)))


def _fit(spark, d):
    return M.als_fit(als_input(spark, d), seed=SEED)


TOLERANCE = 1e-4  # of the score: the lists carry it in single precision


def _dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)


def _tops(lists: DataFrame, other: DataFrame, keys: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n_ids, is_top) of ``lists`` (id, ids): its distinct ids, and whether the product of the factors ``keys`` and
    ``ids`` at every rank is the score that ``other`` (id, scores) has there."""
    listed = lists.select("id", F.size("ids").alias("n"), F.posexplode("ids").alias("at", "other_id"))
    scored = (listed.join(keys.select("id", F.col("features").alias("x")), "id")
              .join(ids.select(F.col("id").alias("other_id"), F.col("features").alias("y")), "other_id")
              .select("id", "n", "at", "other_id", _dot("x", "y").alias("got"))
              .join(other, "id").withColumn("want", F.get("scores", "at").cast("double")))
    fits = F.abs(F.col("got") - F.col("want")) <= TOLERANCE * F.greatest(F.abs("want"), F.lit(1.0))
    return scored.groupBy(F.col("id").cast("bigint").alias("id")).agg(
        F.count_distinct("other_id").cast("int").alias("n_ids"),
        (F.bool_and(F.coalesce(fits, F.lit(False))) & (F.count(F.lit(1)) == F.max("n"))
         & (F.max("n") == F.max(F.size("scores")))).alias("is_top"))


def _scores(recs: DataFrame, key: str) -> DataFrame:
    return recs.select(F.col(key).alias("id"), F.col("recommendations.rating").alias("scores"))


def _user_tops(model, lists: DataFrame, n: int, users: DataFrame | None = None, bounds: bool = True) -> DataFrame:
    """``lists`` (id, ids) of users against the scores found by the other way."""
    return _tops(lists, _scores(M.als_recs(model, n, bounds, users), "userId"), model.userFactors, model.itemFactors)


# --- the outputs themselves -------------------------------------------------------------------------------

def top_titles(spark, d, n: int = TITLES) -> DataFrame:
    """The headline flow: all rated pairs -> ALS -> top-n items per user ->
    titles. Output (user_id, pos, item_id, title)."""
    return V.rec_titles(M.als_user_recs(_fit(spark, d), n), T.items_table(spark, d))


def build_rec_lists(spark, d) -> DataFrame:
    users, items = M.build_rec_lists(als_input(spark, d), seed=SEED)
    return (users.select(F.lit("user").alias("kind"), F.col("user_id").alias("key"), F.col("item_ids").alias("ids"))
            .unionByName(items.select(F.lit("item").alias("kind"), F.col("item_id").alias("key"),
                                      F.col("neighbour_ids").alias("ids"))))


def als_precision_recall(spark, d) -> DataFrame:
    return M.evaluate_als(als_input(spark, d), rank=M.EVAL_RANK, ks=E.K_GRID, seed=SEED)


RAW = {"top_titles": top_titles, "build_rec_lists": build_rec_lists, "als_precision_recall": als_precision_recall}


# --- the queries ------------------------------------------------------------------------------------------

@query("als_fit", with_(RATED) + "SELECT DISTINCT user_id, true AS solved FROM rated")
def q_als_fit(spark, d):
    # The last half-step solves each user's regularised normal equation
    # against the final item factors: sum of (x.f - r) f over the user's
    # items, plus reg * (number of ratings) * x, must vanish.
    ratings = written(als_input(spark, d), "ratings")
    model = M.als_fit(ratings, seed=SEED)
    # Every rating carries its item's factors to its user: some users at a time, so that these are not all on disk at once.
    parts = math.ceil(max(1, ratings.count()) / CHECKED)
    part = F.pmod(F.xxhash64("userId"), F.lit(parts))
    return reduce(DataFrame.unionByName, [written(_solved(ratings.where(part == k), model), "solved") for k in range(parts)])


def _solved(ratings: DataFrame, model) -> DataFrame:
    items = M.item_factors(model).select(F.col("id").alias("movieId"), F.col("features").alias("f"))
    users = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("x"))
    rows = ratings.join(items, "movieId").join(users, "userId").withColumn("e", _dot("x", "f") - F.col("rating"))
    left = [F.sum(F.col("e") * F.col("f")[k] + M.REG_PARAM * F.col("x")[k]) for k in range(model.rank)]
    scale = [F.sum(F.abs(F.col("rating") * F.col("f")[k])) for k in range(model.rank)]
    return rows.groupBy(F.col("userId").cast("bigint").alias("user_id")).agg(
        (F.greatest(*[F.abs(a) / F.greatest(b, F.lit(1.0)) for a, b in zip(left, scale)]) < 1e-3).alias("solved"))


@query("als_predict", with_(SPLIT) + """
SELECT user_id, item_id, true AS is_dot FROM test
WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""")
def q_als_predict(spark, d):
    train, test = R.split_ratings(als_input(spark, d), user_col="userId", item_col="movieId")
    model = M.als_fit(train, seed=SEED)
    got = (M.als_predict(model, test)
           .join(model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("x")), "userId")
           .join(M.item_factors(model).select(F.col("id").alias("movieId"), F.col("features").alias("f")), "movieId"))
    dot = F.aggregate(F.zip_with("x", "f", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    return got.select(F.col("userId").cast("bigint").alias("user_id"), F.col("movieId").cast("bigint").alias("item_id"),
                      (F.abs(F.col("prediction") - dot) < 1e-4).alias("is_dot"))


@query("als_user_recs", with_(RATED) + f"""
SELECT DISTINCT user_id, CAST(least({M.USER_RECS}, items) AS INT) AS n_ids, true AS is_top FROM rated, n""")
def q_als_user_recs(spark, d):
    model = _fit(spark, d)
    lists = M.als_user_recs(model).select(F.col("user_id").alias("id"), F.col("item_ids").alias("ids"))
    return _user_tops(model, lists, M.USER_RECS).withColumnRenamed("id", "user_id")


@query("als_user_recs_bounds", with_(RATED) + f"""
SELECT DISTINCT user_id, CAST(least({M.USER_RECS}, items) AS INT) AS n_ids, true AS is_top FROM rated, n""")
def q_als_user_recs_bounds(spark, d):
    model = _fit(spark, d)
    lists = M.als_user_recs(model, bounds=True).select(F.col("user_id").alias("id"), F.col("item_ids").alias("ids"))
    return _user_tops(model, lists, M.USER_RECS, bounds=False).withColumnRenamed("id", "user_id")


@query("rec_ids", with_(RATED) + f"""
SELECT DISTINCT user_id, CAST(least({M.USER_RECS}, items) AS INT) AS n_ids, true AS is_top FROM rated, n""")
def q_rec_ids(spark, d):
    model = _fit(spark, d)
    lists = M.rec_ids(M.als_recs(model)).select(F.col("userId").alias("id"), F.col("item_ids").alias("ids"))
    return _user_tops(model, lists, M.USER_RECS).withColumnRenamed("id", "user_id")


@query("als_subset_recs", with_(SPLIT) + f"""
SELECT DISTINCT user_id, CAST(least({M.USER_RECS}, (SELECT count(DISTINCT item_id) FROM train)) AS INT) AS n_ids,
       true AS is_top
FROM test WHERE user_id IN (SELECT user_id FROM train)""")
def q_als_subset_recs(spark, d):
    train, test = R.split_ratings(als_input(spark, d), user_col="userId", item_col="movieId")
    model = M.als_fit(train, seed=SEED)
    lists = M.rec_ids(M.als_subset_recs(model, test, M.USER_RECS), out="ids").withColumnRenamed("userId", "id")
    return _user_tops(model, lists, M.USER_RECS, test).withColumnRenamed("id", "user_id")


@query("als_item_audience", with_(RATED) + f"""
SELECT DISTINCT item_id, CAST(least({M.USER_RECS}, users) AS INT) AS n_ids, true AS is_top FROM rated, n""")
def q_als_item_audience(spark, d):
    model = _fit(spark, d)
    lists = M.als_item_audience(model).select(F.col("item_id").alias("id"), F.col("user_ids").alias("ids"))
    other = _scores(M.als_item_recs(model, bounds=True), "movieId")
    return _tops(lists, other, model.itemFactors, model.userFactors).withColumnRenamed("id", "item_id")


@query("als_similar_items", with_(RATED) + f"""
SELECT DISTINCT item_id, least({M.ITEM_RECS}, items - 1) AS n_ids, true AS is_cosine, true AS descending, true AS not_self
FROM rated, n""")
def q_als_similar_items(spark, d):
    model = _fit(spark, d)
    got = M.als_similar_items(model)
    f = M.item_factors(model).select(F.col("id").cast("bigint").alias("id"), "features")
    pairs = (got.join(f.withColumnsRenamed({"id": "item_id", "features": "a"}), "item_id")
             .join(f.withColumnsRenamed({"id": "neighbour_id", "features": "b"}), "neighbour_id"))
    return pairs.withColumn("cos", cosine("a", "b")).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_ids"), F.bool_and(F.abs(F.col("cos") - F.col("sim")) < 1e-6).alias("is_cosine"),
        (F.array_sort(F.collect_list(F.struct("rank", "sim")))["sim"]
         == F.sort_array(F.collect_list("sim"), False)).alias("descending"),
        F.bool_and(F.col("item_id") != F.col("neighbour_id")).alias("not_self"))


@query("build_rec_lists", with_(RATED) + f"""
SELECT 'user' AS kind, user_id AS key, CAST(least({M.USER_RECS}, items) AS INT) AS n_ids FROM rated, n GROUP BY ALL
UNION ALL SELECT 'item', item_id, CAST(least({M.ITEM_RECS}, items - 1) AS INT) FROM rated, n GROUP BY ALL""")
def q_build_rec_lists(spark, d):
    return build_rec_lists(spark, d).select("kind", F.col("key").cast("bigint").alias("key"),
                                            F.size(F.array_distinct("ids")).alias("n_ids"))


@query("als_precision_recall", with_(SPLIT) + f"""
, u AS (SELECT user_id, count(*) AS n FROM test WHERE user_id IN (SELECT user_id FROM train) GROUP BY user_id)
SELECT k, CAST((SELECT count(*) FROM u) * least(k, (SELECT count(DISTINCT item_id) FROM train)) AS BIGINT) AS n_rec,
       CAST((SELECT sum(n) FROM u) AS BIGINT) AS n_test, true AS recounted
FROM (SELECT unnest({list(E.K_GRID)}) AS k)""")
def q_als_precision_recall(spark, d):
    # The hits again, by another path: the place of each test item in its user's list.
    train, test = R.split_ratings(als_input(spark, d), user_col="userId", item_col="movieId")
    lists = M.rec_ids(M.als_subset_recs(M.als_fit(train, M.EVAL_RANK, SEED), test, max(E.K_GRID), bounds=True))
    at = test.join(lists, "userId").select(F.array_position("item_ids", F.col("movieId")).alias("at")).where("at > 0")
    again = at.agg(*[F.count_if(F.col("at") <= k).alias(str(k)) for k in E.K_GRID]).select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(str(k)).alias("again")) for k in E.K_GRID])).alias("r"))
    return als_precision_recall(spark, d).join(again.select("r.*"), "k").select(
        "k", "n_rec", "n_test",
        ((F.abs(F.col("precision") * F.col("n_rec") / 100 - F.col("again")) < 1e-6)
         & (F.abs(F.col("recall") * F.col("n_test") / 100 - F.col("again")) < 1e-6)
         & (F.col("hits") == F.col("again"))).alias("recounted"))


@query("rank_grid", f"SELECT unnest({list(M.RANK_GRID)}) AS rank, true AS recomputed")
def q_rank_grid(spark, d):
    """The least rank's error is recomputed from the factors of its fits; the others must be finite."""
    data, low = als_input(spark, d), min(M.RANK_GRID)
    grid = M.rank_grid(data, seed=SEED)
    again = None
    fixed = M.grid_data(data)
    for t in range(M.GRID_SPLITS):
        train, test = fixed.randomSplit([0.8, 0.2], SEED + t)
        model = M.grid_fit(train, low, SEED + t)
        rows = (test.join(model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("x")), "userId")
                .join(model.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("y")), "movieId"))
        one = rows.agg(F.avg(F.pow(_dot("x", "y") - F.col("rating"), 2)).alias("mse"))
        again = one if again is None else again.unionByName(one)
    return grid.crossJoin(F.broadcast(again.agg(F.avg("mse").alias("again")))).select(  # one row
        "rank", F.when(F.col("rank") == low, F.abs(F.col("mse") - F.col("again")) < 1e-3 * F.col("again")).otherwise(
            F.col("mse").isNotNull() & ~F.isnan("mse") & (F.col("mse") > 0) & (F.col("mse") < 1e6)).alias("recomputed"))


@query("best_rank", "SELECT true AS is_least, true AS in_grid")
def q_best_rank(spark, d):
    rows = M.rank_grid(als_input(spark, d), seed=SEED).select("rank", "mse").persist()  # one row per rank
    best = M.best_rank(rows).select(F.col("rank").alias("best"), F.col("mse").alias("least"))
    first = rows.orderBy("mse", "rank").limit(1)
    return best.crossJoin(first).select(  # one row each
        ((F.col("best") == F.col("rank")) & (F.col("least") == F.col("mse"))).alias("is_least"),
        F.col("best").isin(*M.RANK_GRID).alias("in_grid"))


@query("top_titles", with_(RATED) + f"""
SELECT DISTINCT user_id, least({TITLES}, items) AS n_titles, true AS titled, true AS is_top FROM rated, n""")
def q_top_titles(spark, d):
    names = T.items_table(spark, d).select("item_id", F.col("name").alias("stored"))
    got = top_titles(spark, d)
    titles = got.join(names, "item_id").groupBy(F.col("user_id").cast("bigint").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n_titles"), F.bool_and(F.col("title").eqNullSafe(F.col("stored"))).alias("titled"))
    lists = got.groupBy(F.col("user_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "item_id")))["item_id"].alias("ids"))  # TITLES at most
    tops = _user_tops(_fit(spark, d), lists, TITLES).select(F.col("id").alias("user_id"), "is_top")
    return titles.join(tops, "user_id")


@query("refresh_rec_lists", with_(RATINGS_BASE, RATING_EVENTS, OLD_U, OLD_I) + f"""
, rated AS (SELECT * FROM ratings_base WHERE score > 0),
n AS (SELECT count(DISTINCT item_id) AS items FROM rated)
SELECT 'user' AS kind, user_id AS key, CAST(least({M.USER_RECS}, items) AS INT) AS n_ids
FROM (SELECT DISTINCT user_id FROM rated), n
UNION ALL SELECT 'item', item_id, CAST(least({M.ITEM_RECS}, items - 1) AS INT) FROM (SELECT DISTINCT item_id FROM rated), n
UNION ALL SELECT 'user', user_id, CAST(len(ids) AS INT) FROM old_u WHERE user_id NOT IN (SELECT user_id FROM rated)
UNION ALL SELECT 'item', item_id, CAST(len(ids) AS INT) FROM old_i WHERE item_id NOT IN (SELECT item_id FROM rated)""")
def q_refresh_rec_lists(spark, d):
    """Both stored tables after a refresh over older snapshots: new lists win, other keys stay."""
    root = scratch_path(spark, "recs-store")
    old_u = ST.write_snapshot(user_lists(spark, d, "old"), f"{root}/user_recs")
    old_i = ST.write_snapshot(item_lists(spark, d, "old"), f"{root}/item_recs")
    paths = refresh_rec_lists(spark, als_input(spark, d), root, old_u, old_i, seed=SEED)
    out = [spark.read.parquet(paths[t]).select(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("key"),
                                               F.size(ids).alias("n_ids"))
           for t, kind, key, ids in (("user_recs", "user", "user_id", "item_ids"),
                                     ("item_recs", "item", "item_id", "neighbour_ids"))]
    return out[0].unionByName(out[1])
