"""Sampling, name and markup matching, pushed-down lookup, crawl store, stream store, block sizes, ALS layout."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from recsmith.operators import ingest as I, model as M, pages as P, ratings as R, serve as V, similarity as S
from recsmith.plans import crawl as C
from recsmith.sources import store as ST, tables as T
from recsmith.streaming import ingest as L

SF = "/root/testdata/sf0.001"


def test_draws_with_replacement_repeat_as_often_as_independent_ones(spark):
    lists = spark.range(2000).select(F.col("id").cast("int").alias("user_id"),
                                     F.sequence(F.lit(1), F.lit(5)).alias("item_ids"))
    rows = V.sample_user_recs(lists.select("user_id", F.lit(3).alias("n")), lists, seed=7).collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user_id, []).append(r.item_id)
    repeats = sum(len(set(v)) < 3 for v in by_user.values()) / len(by_user)
    assert abs(repeats - (1 - 4 / 5 * 3 / 5)) < 0.05
    counts = Counter(r.item_id for r in rows)
    assert max(counts.values()) < 1.15 * min(counts.values())


@pytest.mark.parametrize("seed", [0, 7, 123])
def test_draws_without_replacement_are_no_prefix(spark, seed):
    lists = spark.range(500).select((F.col("id") + 4_000_000_000).alias("user_id"),
                                    F.sequence(F.lit(1), F.lit(6)).alias("item_ids"))
    got = V.sample_user_recs(lists.select("user_id", F.lit(3).alias("n")), lists, seed=seed, replace=False)
    sets = {}
    for r in got.collect():
        sets.setdefault(r.user_id, []).append(r.item_id)
    assert all(len(set(v)) == 3 for v in sets.values())
    assert len({tuple(v) for v in sets.values()}) > 50


def test_names_match_with_blanks(spark):
    users = spark.createDataFrame([(2, "a b"), (1, "a-b"), (3, "c")], "user_id int, name string")
    rows = spark.createDataFrame([("a-b", 5), ("a b", 4), ("d", 1)], "user_name string, score int")
    got = {(r.user_name, r.user_id) for r in I.attach_user_ids(rows, users).collect()}
    assert got == {("a-b", 1), ("a b", 1)}


def test_nested_section_and_class_lists(spark):
    html = ('<div id="movie"><div class="hd"></div><span class="pl"><a href="u/collect">950 x</a></span></div>'
            '<div id="book"><span class="pl"><a href="b/collect">990 x</a></span></div>')
    pages = spark.createDataFrame([(1, html), (2, html.replace('id="movie"', 'id="music"'))], "page_id int, html string")
    got = P.extract_collection_link(pages).collect()
    assert [(r.page_id, r.collect_url, r.n_collected) for r in got] == [(1, "u/collect?", 950)]
    items = spark.createDataFrame([(1, '<div class="item odd"></div><div class="x item"></div><div class="item">'
                                       '</div><div class="comment-item"></div>')], "page_id int, html string")
    assert P.extract_items(items).count() == 3
    assert P.blocks(items, P.COMMENT_MARKER).count() == 1


def test_lookup_reaches_the_scan(spark, capsys):
    part = T.table(spark, SF, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))
    R.lookup_by_key(part, item_id=7).explain("formatted")
    assert "EqualTo(p_partkey,7)" in capsys.readouterr().out


def test_upsert_computes_the_new_side_once(spark):
    old = spark.createDataFrame([(1, [1]), (2, [2])], "user_id int, item_ids array<int>")
    new = spark.createDataFrame([([9], 2), ([3], 3), (None, 4)], "item_ids array<int>, user_id int")
    got = sorted((r.user_id, r.item_ids) for r in ST.upsert_user_recs(old, new).collect())
    assert got == [(1, [1]), (2, [9]), (3, [3]), (4, None)]


def test_crawl_store_and_backfill(spark, tmp_path):
    profiles = spark.createDataFrame([(1, "home", '<div class="info"><h1>x (2)</h1></div>'
                                       '<div class="side-info-txt"><h3>a b</h3></div>')],
                                     "page_id long, url string, html string")
    block = ('<div class="item"><div class="info"><a href="u{0}"><em>t{0}</em></a></div><li class="intro">s</li>'
             '<span class="rating{0}-t"></span></div>')
    pages = spark.createDataFrame([(1, block.format(3) + block.format(4), "a-b")],
                                  "page_id long, html string, user_name string")
    users = spark.createDataFrame([(7, "z", 1, "h")], "user_id int, name string, declared_total int, home_url string")
    stored = spark.createDataFrame([("u3", 8)], "item_url string, user_id int")
    catalogue = spark.createDataFrame([(5, "u4")], "item_id int, item_url string")
    crawl = C.ingest_crawl(profiles, pages, users, stored, catalogue)
    paths = crawl.store(str(tmp_path))
    assert sorted((r.user_id, r.name) for r in spark.read.parquet(paths["users"]).collect()) == [(7, "z"), (8, "a b")]
    assert [(r.item_url, r.user_id, r.score) for r in spark.read.parquet(paths["ratings"]).collect()] == [("u4", 8, 4)]
    assert [(r.item_url, r.item_id) for r in spark.read.parquet(paths["items"]).collect()] == [("u3", 6)]
    facts = spark.createDataFrame([("u9", "n", "s"), ("u4", "n", "s")], "item_url string, item_name string, summary string")
    path = C.backfill_catalogue(facts, catalogue, str(tmp_path / "back"))
    assert [(r.item_url, r.item_id) for r in spark.read.parquet(path).collect()] == [("u9", 6)]


def test_stream_batch_fails_when_the_store_cannot_be_read(spark, tmp_path):
    target = tmp_path / "store"
    (target / f"{L.BUCKET}=0").mkdir(parents=True)
    for b in range(L.BUCKETS):
        (target / f"{L.BUCKET}={b}").mkdir(exist_ok=True)
        (target / f"{L.BUCKET}={b}" / "part-0.parquet").write_bytes(b"not parquet")
    batch = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    with pytest.raises(Exception):
        L.ingest_batch(batch, str(target), lambda p: p.select(F.col("url").alias("item_url")), ["item_url"])


def test_blocks_follow_data_and_slots():
    assert M.data_blocks(0) == M.data_blocks(9_000) == 1 and M.data_blocks(1_000_000) == 10
    assert M.data_blocks(10 ** 12) == 10_000
    assert S.auto_block_size(500, 8) < 500 and S.auto_block_size(10 ** 9, 1000) == S.MAX_BLOCK


def test_one_seed_one_model_whatever_the_input_layout(spark):
    ratings = R.to_als_ratings(R.rated_only(T.ratings_base(spark, SF)))
    a, b = (M.als_user_recs(M.als_fit(ratings.repartition(k), rank=5, seed=3), 5) for k in (2, 7))
    assert sorted(map(tuple, ((r.user_id, tuple(r.item_ids)) for r in a.collect()))) == \
        sorted(map(tuple, ((r.user_id, tuple(r.item_ids)) for r in b.collect())))


def test_similar_items_of_many_blocks_equal_one_block(spark):
    vectors = T.table(spark, SF, "embeddings")
    many, one = (S.similar_items(vectors, 5, id_col="vec_id", vec_col="embedding", block_size=k) for k in (17, 10 ** 6))
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))
