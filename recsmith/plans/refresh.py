"""Recommendation refresh: fit once, upsert both stored lists (H6 + A7/A8).

The reference's main run fits ALS, then writes each user's and each item's
list one row at a time. Here both lists are computed as DataFrames and
each stored table is replaced by a new snapshot (new rows win, untouched
keys stay), one job per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import model as M
from ..sources import store as ST


def refresh_rec_lists(spark: SparkSession, ratings: DataFrame, store_root: str,
                            user_snapshot: str | None = None, item_snapshot: str | None = None,
                            rank: int = M.MAIN_RANK, user_n: int = M.USER_RECS, item_n: int = M.ITEM_RECS,
                            seed: int = 42) -> dict[str, str]:
    """Returns the paths of the new ``user_recs`` and ``item_recs`` snapshots."""
    users, items = M.build_rec_lists(ratings, rank, user_n, item_n, seed=seed)
    root = store_root.rstrip("/")
    return {
        "user_recs": ST.upsert_snapshot(spark, user_snapshot, users, "user_id", f"{root}/user_recs"),
        "item_recs": ST.upsert_snapshot(spark, item_snapshot, items, "item_id", f"{root}/item_recs"),
    }
