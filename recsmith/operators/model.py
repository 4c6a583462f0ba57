"""ALS model: fit, factors, predictions, top-N lists, rank grid (H1-H3, H6,
E3, E4, G4, G5, D7, D8).

Spark ML's ALS is called, not rewritten: it is blocked and distributed.
Its lists come from ``bounded.top_products``: a blocked product of every user
with every item or, with ``bounds``, one that skips the items that a bound rules
out: many where the items' norms spread or their directions cluster, none where
both are even. The lists are the same, and those of Spark ML's
``recommendForAllUsers``, which sorts the n best of every user in each block of
4096 items, so that what it writes grows with users times items. Nothing is collected. The reference's regex over ``str(Row)`` becomes a
plain field projection.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from ..session import drop_path, drop_unreferenced, dropping_shuffles, scratch_dir, scratch_path, written, written_meanwhile
from . import evaluate as E
from .bounded import top_lists
from .ratings import split_ratings
from .similarity import auto_block_size, neighbour_lists, similar_items

# The reference's ALS settings.
MAX_ITER = 5
REG_PARAM = 0.01
MAIN_RANK = 30
EVAL_RANK = 5
USER_RECS = 20
ITEM_RECS = 10
RANK_GRID = (5, 10, 15, 20, 25)
GRID_SPLITS = 5
GRID_THREADS = 8  # fits of the rank grid that run side by side, on few ratings
GRID_MANY = 3  # on more: each keeps its shuffles of the ratings on disk, and has more blocks in turn
BLOCK_ROOT = 10_000  # ratings a block holds when there is one; blocks grow with the root of the ratings at first
FEW = 1_000_000  # ratings of which a fit's files are small: it has blocks for the cores, and keeps its shuffles
BLOCKS = 4  # blocks a side beyond these, until they are full
BLOCK_RATINGS = 24_000_000  # ratings a full block holds: about 300 MB, and the factors it needs besides


def als(rank: int = MAIN_RANK, max_iter: int = MAX_ITER, reg_param: float = REG_PARAM, seed: int = 42,
        n_blocks: int | None = None, cold_start: str = "drop", checkpoint_interval: int | None = None) -> ALS:
    """Estimator with the reference's settings (explicit feedback); the seed
    is always set so that runs repeat."""
    est = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, userCol="userId", itemCol="movieId",
              ratingCol="rating", coldStartStrategy=cold_start, seed=seed)
    if n_blocks:
        est = est.setNumUserBlocks(n_blocks).setNumItemBlocks(n_blocks)
    return est.setCheckpointInterval(checkpoint_interval) if checkpoint_interval else est


def data_blocks(n_ratings: int, most: int | None = None) -> int:
    """ALS user/item blocks, from the number of ratings alone.

    A half-step sends every factor to each block that needs it: with few
    ratings a user or item and many blocks, about once a rating. So beyond ``FEW`` ratings there are
    no more than ``BLOCKS`` blocks (or ``most`` at any number) while these hold their ratings in
    memory, and what is sent grows with the factors, not with the blocks too. The cluster
    does not enter: the blocks are part of the model, and one seed gives one
    model on any cluster.
    """
    root = math.ceil(math.sqrt(n_ratings / BLOCK_ROOT))
    most = most or (root if n_ratings <= FEW else BLOCKS)
    return max(1, min(root, max(most, math.ceil(n_ratings / BLOCK_RATINGS))))


def stable_layout(ratings: DataFrame, n_partitions: int) -> DataFrame:
    """Fixed input layout (hash by user, sorted within partitions): with a
    seed, ALS then gives the same factors run after run."""
    return ratings.repartition(n_partitions, "userId").sortWithinPartitions("userId", "movieId")


def als_fit(ratings: DataFrame, rank: int = MAIN_RANK, seed: int = 42, max_iter: int = MAX_ITER,
            reg_param: float = REG_PARAM, n_blocks: int | None = None) -> ALSModel:
    """H1: fit on (userId, movieId, rating). The shared checkpoint folder
    is registered so that ALS can cut its lineage on long runs."""
    with written_meanwhile(ratings.select("userId", "movieId", "rating"), "ratings") as stored:
        n = stored.count()
        return _fit(stored, n, rank, seed, max_iter, reg_param, n_blocks or data_blocks(n))


def _fit(stored: DataFrame, n: int, rank: int, seed: int, max_iter: int, reg_param: float, n_blocks: int,
         path: str | None = None) -> ALSModel:
    """A fit on ``n`` stored ratings that outlives them, stored at ``path`` (default: one of its own) if at all.

    Beyond ``FEW`` ratings the factors are cut off at every step, which drops the shuffles of the step before, and stored
    at the end, so that nothing refers to the ratings' shuffles either.
    """
    spark = stored.sparkSession
    scratch_dir(spark)
    laid = stable_layout(stored, n_blocks)
    if n <= FEW:
        return als(rank, max_iter, reg_param, seed, n_blocks).fit(laid)
    with written_meanwhile(laid, "laid") as laid:
        model = als(rank, max_iter, reg_param, seed, n_blocks, checkpoint_interval=1).fit(laid)
        path = path or scratch_path(spark, "model")
        model.write().save(path)
    del model, laid
    drop_unreferenced(spark)
    return ALSModel.load(path)


def item_factors(model: ALSModel) -> DataFrame:
    """H3: (id, features) per item, distributed."""
    return model.itemFactors


def als_predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """H2: predictions for (userId, movieId) pairs; cold-start rows dropped."""
    return model.transform(pairs)


def rec_ids(recs: DataFrame, key: str = "userId", field: str = "movieId", out: str = "item_ids") -> DataFrame:
    """Nested recommendations -> (key, ids in score order)."""
    return recs.select(F.col(key), F.col(f"recommendations.{field}").alias(out))


def _factor_recs(factors: DataFrame, others: DataFrame, n: int, key: str, field: str, bounds: bool = True,
                 report: dict | None = None) -> DataFrame:
    """The nested form of Spark ML's recommendations: (key, recommendations of (field, rating)), best first."""
    n_others = others.count()
    block = auto_block_size(n_others, factors.sparkSession.sparkContext.defaultParallelism)
    lists = top_lists(factors.select("id", F.col("features").alias("v")),
                      others.select("id", F.col("features").alias("v")), n, block_size=block, n_items=n_others,
                      report=report, bounds=bounds).withColumnsRenamed({"other_ids": field, "scores": "rating"})
    return lists.select(F.col("id").alias(key), F.arrays_zip(field, "rating").alias("recommendations"))


def als_recs(model: ALSModel, n: int = USER_RECS, bounds: bool = False, users: DataFrame | None = None,
             report: dict | None = None) -> DataFrame:
    """The n best items of every user, or of the distinct ``users`` (column userId) that have factors, as
    (userId, recommendations); equal scores are ordered by item id."""
    asked = model.userFactors
    if users is not None:
        asked = asked.join(users.select(F.col("userId").alias("id")), "id", "left_semi")
    return _factor_recs(asked, model.itemFactors, n, "userId", "movieId", bounds, report)


def als_user_recs(model: ALSModel, n: int = USER_RECS, bounds: bool = False) -> DataFrame:
    """E3 + G4: top-n items per user -> (user_id, item_ids)."""
    return rec_ids(als_recs(model, n, bounds)).select(F.col("userId").alias("user_id"), "item_ids")


def als_subset_recs(model: ALSModel, users: DataFrame, n: int, bounds: bool = False) -> DataFrame:
    """Top-n for the distinct users of ``users`` (column userId)."""
    return als_recs(model, n, bounds, users)


def als_item_recs(model: ALSModel, n: int = USER_RECS, bounds: bool = False) -> DataFrame:
    """The n best users of every item as (movieId, recommendations)."""
    return _factor_recs(model.itemFactors, model.userFactors, n, "movieId", "userId", bounds)


def als_item_audience(model: ALSModel, n: int = USER_RECS, bounds: bool = False) -> DataFrame:
    """Top-n users per item -> (item_id, user_ids)."""
    return rec_ids(als_item_recs(model, n, bounds), key="movieId", field="userId", out="user_ids").select(
        F.col("movieId").alias("item_id"), "user_ids")


def als_similar_items(model: ALSModel, n: int = ITEM_RECS, block_size: int | None = None) -> DataFrame:
    """E5 on the item factors -> (item_id, neighbour_id, sim, rank)."""
    kw = {"block_size": block_size} if block_size else {}
    return similar_items(item_factors(model), n, id_col="id", vec_col="features", **kw)


def build_rec_lists(ratings: DataFrame, rank: int = MAIN_RANK, user_n: int = USER_RECS, item_n: int = ITEM_RECS,
                  users: bool = True, items: bool = True, seed: int = 42):
    """H6: fit once; return (user_recs, item_recs) in the stored list forms
    ``(user_id, item_ids)`` and ``(item_id, neighbour_ids)`` (either None
    when not asked for)."""
    model = als_fit(ratings, rank, seed)
    u = als_user_recs(model, user_n) if users else None
    i = neighbour_lists(als_similar_items(model, item_n)) if items else None
    return u, i


def evaluate_als(ratings: DataFrame, rank: int = EVAL_RANK, ks=E.K_GRID, seed: int = 42) -> DataFrame:
    """D11 with ALS: hash 80/20 split, fit on train, one top-n list at
    max(ks) for the test users (E4), one aggregation over ks."""
    # The ratings feed the fit, the recommended users and the hit join:
    # written once to the shared scratch folder instead of recomputed.
    ratings = written(ratings, "ratings")
    train, test = split_ratings(ratings, user_col="userId", item_col="movieId")
    model = als_fit(train, rank, seed)
    recs = E.recs_long(als_subset_recs(model, test, max(ks), bounds=True))  # few dimensions: most items are ruled out
    test_l = test.select(F.col("userId").alias("user_id"), F.col("movieId").alias("item_id"))
    return E.precision_recall_curve(recs, test_l, ks)


def grid_data(ratings: DataFrame) -> DataFrame:
    """The ratings written once in a layout that follows from them alone: the same random splits whenever it is made."""
    slots = ratings.sparkSession.sparkContext.defaultParallelism
    return written(stable_layout(ratings.select("userId", "movieId", "rating"), slots), "grid")


def grid_fit(train: DataFrame, rank: int, seed: int) -> ALSModel:
    """A fit of the rank grid."""
    with written_meanwhile(train, "train") as stored:
        return _grid_fit(stored, stored.count(), rank, seed)


def _grid_fit(stored: DataFrame, n: int, rank: int, seed: int, path: str | None = None) -> ALSModel:
    """On few ratings many run side by side, so each has as few blocks as hold its ratings."""
    return _fit(stored, n, rank, seed, MAX_ITER, REG_PARAM, data_blocks(n, 1) if n <= FEW else data_blocks(n), path)


def rank_grid(ratings: DataFrame, ranks=RANK_GRID, splits: int = GRID_SPLITS, seed: int = 42) -> DataFrame:
    """For each rank, ``splits`` random 80/20 splits; mean test MSE.

    One distributed fit per (rank, split) over the input, which is written
    once to the shared scratch folder, as is each split for the time of its fits. Some fits are submitted
    side by side, so the cluster does not idle in the short stages of one; what
    a fit leaves on disk goes when it ends.
    Returns (rank, mse) with one row per rank.
    """
    spark = ratings.sparkSession
    data = grid_data(ratings)
    few = data.count() <= FEW

    def of_split(t):
        train, test = data.randomSplit([0.8, 0.2], seed + t)
        with written_meanwhile(train, "train") as train, written_meanwhile(test, "test") as test:
            n = train.count()

            def fit_one(r):
                path = scratch_path(spark, "model")
                try:
                    m = E.mse(als_predict(_grid_fit(train, n, r, seed + t, path), test)).first()["mse"]
                finally:
                    drop_path(spark, path)
                return int(r), t, float(m) if m is not None else None

            with ThreadPoolExecutor(GRID_THREADS if few else GRID_MANY) as pool:
                return list(pool.map(inheritable_thread_target(spark)(fit_one), ranks))

    with dropping_shuffles(spark), ThreadPoolExecutor(2 if few else 1) as pool:
        rows = [r for part in pool.map(inheritable_thread_target(spark)(of_split), range(splits)) for r in part]
    per_split = spark.createDataFrame(rows, "rank int, split int, mse double")
    return per_split.groupBy("rank").agg(F.avg("mse").alias("mse"))


def best_rank(grid: DataFrame) -> DataFrame:
    """The rank with the lowest mean MSE (one row)."""
    return grid.agg(F.min_by("rank", "mse").alias("rank"), F.min("mse").alias("mse"))
