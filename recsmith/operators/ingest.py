"""Incremental ingest: dedup against what is stored, crawl decisions and
work lists (C4-C6, C8, D2-D4, D13, E8, K2, K3).

What the reference does one row at a time with check-then-insert is a
key-based anti-join here: exact, and free of the race in which two
workers both miss and both insert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as X
from .prefix import dense_ids, running_sum_before
from .ratings import RATED_QUOTA


def dedup_by_key(df: DataFrame, key_cols, order_cols=None) -> DataFrame:
    """One row per key: the lowest by ``order_cols`` (default: all other
    columns). A struct-min aggregate, combined map-side (skew-safe)."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_cols) if order_cols else []
    fields = order + [c for c in rest if c not in order]
    if not fields:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c) for c in fields]))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b.{c}") for c in rest])


def new_users(candidates: DataFrame, users: DataFrame, cand_name: str = "user_name",
              user_name: str = "name") -> DataFrame:
    """C4: candidates whose normalised name is not stored yet."""
    stored = users.select(X.normalise_name(F.col(user_name)).alias("_n")).distinct()
    return (candidates.withColumn("_n", X.normalise_name(F.col(cand_name)))
            .join(stored, "_n", "left_anti").drop("_n"))


def new_user_count(candidates: DataFrame, users: DataFrame, **kw) -> DataFrame:
    """Number of newly found users (one row)."""
    return new_users(candidates, users, **kw).agg(F.count(F.lit(1)).alias("n_new"))


def new_ratings(batch: DataFrame, stored: DataFrame, key_cols=("item_url", "user_id"), order_cols=None) -> DataFrame:
    """Batch rows whose (url, user) is not stored; one per key."""
    keys = list(key_cols)
    return dedup_by_key(batch, keys, order_cols).join(stored.select(*keys), keys, "left_anti")


def new_items(batch: DataFrame, catalogue: DataFrame, url_col: str = "item_url",
              name_col: str = "item_name", summary_col: str = "summary") -> DataFrame:
    """Catalogue entries for URLs not yet in the catalogue; one per URL
    with the lowest (name, summary)."""
    best = F.min(F.struct(F.col(name_col).alias("name"), F.col(summary_col).alias("summary")))
    uniq = batch.groupBy(url_col).agg(best.alias("_b")).select(
        F.col(url_col).alias("item_url"), "_b.name", "_b.summary")
    return uniq.join(catalogue.select(F.col(url_col).alias("item_url")), "item_url", "left_anti")


def attach_user_ids(rows: DataFrame, users: DataFrame, row_name: str = "user_name",
                    user_name: str = "name") -> DataFrame:
    """User id by normalised name (as in C4 and A9); of several users of
    one name the lowest id wins."""
    ids = users.groupBy(X.normalise_name(F.col(user_name)).alias("_n")).agg(F.min("user_id").alias("user_id"))
    return (rows.drop("user_id").withColumn("_n", X.normalise_name(F.col(row_name)))
            .join(ids, "_n", "inner").drop("_n"))


def assign_item_ids(new_urls: DataFrame, catalogue: DataFrame, url_col: str = "item_url",
                    id_col: str = "item_id") -> DataFrame:
    """K3: ids for new catalogue rows, continuing after the largest stored
    id, in URL order (what AUTO_INCREMENT gives for inserts in that order)."""
    return dense_ids(new_urls, url_col, catalogue.agg(F.max(id_col).alias("m")), id_col)


def crawl_status(ratings: DataFrame, users: DataFrame, quota: int = RATED_QUOTA, get_all: bool = False,
                 name_col: str = "user_name", score_col: str = "score") -> DataFrame:
    """D2 + D3 + D4 in one aggregation per known user.

    ``quota_reached``: rated rows > quota (D2); ``complete``: all rows >=
    declared total (D3); ``skip`` the user when complete, or when the quota
    is reached and not everything is wanted (D4).
    """
    counts = ratings.groupBy(F.col(name_col).alias("name")).agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.col(score_col) > 0).alias("n_rated"))
    known = users.groupBy("name").agg(F.min("declared_total").alias("declared_total"))
    got = known.join(counts, "name", "left").fillna(0, ["n_all", "n_rated"])
    quota_reached = F.col("n_rated") > F.lit(quota)
    complete = F.col("n_all") >= F.col("declared_total")
    skip = complete | (F.lit(not get_all) & quota_reached)
    return got.select("name", "declared_total", "n_all", "n_rated", quota_reached.alias("quota_reached"),
                      complete.alias("complete"), skip.alias("skip"))


def quota_pages(page_counts: DataFrame, stored: DataFrame, quota: int = RATED_QUOTA, key_col: str = "user_id",
                page_col: str = "page", rated_col: str = "n_rated", stored_col: str = "n_stored") -> DataFrame:
    """The pages crawled before the quota stop.

    Page ``i`` is read while ``stored + rated on pages before i <= quota``
    (the check runs before the first page and after each page). The
    running sum is skew-safe (``running_sum_before``).
    """
    run = running_sum_before(page_counts, key_col, page_col, rated_col, "_before", start=stored,
                             start_col=stored_col)
    return run.filter(F.col("_before") <= F.lit(quota)).drop("_before")


WORKLIST_CHUNK = 4096


def page_worklist(profiles: DataFrame, status: DataFrame | None = None, key_col: str = "name",
                  base_col: str = "home_url", pages_col: str = "page_count", step: int = X.PAGE_STEP,
                  inclusive: bool = False, chunk: int = WORKLIST_CHUNK) -> DataFrame:
    """K2: (key, page, start, url) for every page of every user still to
    crawl; users whose ``status.skip`` is true are removed (anti-join).

    A user's pages are first cut into chunks of ``chunk`` pages (one small
    descriptor row each), the descriptors are spread over the cluster, and
    only then expanded: a user with millions of pages does not generate
    them all in one task.
    """
    todo = profiles
    if status is not None:
        todo = todo.join(status.filter(F.col("skip")).select(key_col), key_col, "left_anti")
    n = F.col(pages_col) + (1 if inclusive else 0)
    n_chunks = F.greatest(F.ceil(n / F.lit(chunk)), F.lit(1)).cast("int")
    desc = todo.select(key_col, base_col, n.alias("_n"),
                       F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("_c"))
    slots = profiles.sparkSession.sparkContext.defaultParallelism
    desc = desc.repartition(slots, key_col, "_c")
    lo = F.col("_c") * chunk
    offsets = X.page_offsets(F.least(lo + chunk, F.col("_n")), step, first=lo)
    pages = desc.select(key_col, base_col, F.explode(offsets).alias("start"))
    return pages.select(key_col, (F.col("start") / step).cast("int").alias("page"), F.col("start").cast("int").alias("start"),
                        X.page_url(F.col(base_col), F.col("start")).alias("url"))


def seed_page_worklist(items: DataFrame, url_col: str = "item_url", key_col: str = "item_id",
                       pages: int = X.SEED_PAGES, step: int = X.SEED_PAGE_STEP) -> DataFrame:
    """K2 for seed discovery: the first ``pages`` comment pages of every
    item (offsets ``step * i``), as (key, page, url)."""
    offs = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(pages - 1)), lambda i: i * step))
    return items.select(key_col, url_col, offs.alias("page", "start")).select(
        key_col, "page", X.comment_page_url(F.col(url_col), F.col("start")).alias("url"))


def rated_quota_reached(ratings: DataFrame, users: DataFrame, quota: int = RATED_QUOTA, **kw) -> DataFrame:
    """Per known user, whether its rated rows exceed ``quota``."""
    return crawl_status(ratings, users, quota, **kw).select("name", "n_rated", "quota_reached")


def collection_complete(ratings: DataFrame, users: DataFrame, **kw) -> DataFrame:
    """D3: per known user, whether its stored rows reach the declared total."""
    return crawl_status(ratings, users, **kw).select("name", "n_all", "declared_total", "complete")


def filter_heavy_users(links: DataFrame, min_count: int = 900, count_col: str = "n") -> DataFrame:
    """Links whose leading number is strictly above ``min_count``."""
    return links.filter(F.coalesce(F.col(count_col), F.lit(-1)) > F.lit(min_count))


def filter_link_contains(links: DataFrame, word: str, href_col: str = "href") -> DataFrame:
    """Links whose address contains ``word``."""
    return links.filter(F.col(href_col).contains(word))
