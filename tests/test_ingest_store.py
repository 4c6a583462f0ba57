import random


from recsmith.operators import ingest as I, prefix as PX, ratings as R
from recsmith.sources import store as S


def test_running_sum_before_matches_python(spark):
    rnd = random.Random(3)
    rows = [(k, p, rnd.randint(0, 5)) for k in range(3) for p in rnd.sample(range(50), 20)]
    df = spark.createDataFrame(rows, "k int, p int, v int")
    got = {(r.k, r.p): r.sum_before for r in PX.running_sum_before(df, "k", "p", "v", chunk=4).collect()}
    for k, p, _ in rows:
        assert got[(k, p)] == sum(v for kk, pp, v in rows if kk == k and pp < p)


def test_dense_ids(spark):
    urls = [f"u{i:03d}" for i in random.Random(1).sample(range(500), 200)]
    df = spark.createDataFrame([(u,) for u in urls], "item_url string").repartition(7)
    got = {r.item_url: r.id for r in PX.dense_ids(df, "item_url", 41).collect()}
    assert got == {u: 42 + i for i, u in enumerate(sorted(urls))}


def test_quota_pages_boundaries(spark):
    # stored 0, pages rated 10, 10, 10, 10: with quota 20 pages 0..2 are read
    # (before page 2 the count is 20, not above the quota).
    pc = spark.createDataFrame([(1, p, 10) for p in range(4)], "user_id int, page int, n_rated int")
    st = spark.createDataFrame([(1, 0)], "user_id int, n_stored int")
    got = sorted(r.page for r in I.quota_pages(pc, st, quota=20).collect())
    assert got == [0, 1, 2]
    st = spark.createDataFrame([(1, 21)], "user_id int, n_stored int")
    assert I.quota_pages(pc, st, quota=20).count() == 0


def test_crawl_status_boundaries(spark):
    users = spark.createDataFrame([("a", 3), ("b", 4)], "name string, declared_total int")
    ratings = spark.createDataFrame([("a", 1), ("a", 1), ("a", 0), ("b", 1), ("b", 1), ("b", 1)],
                                    "user_name string, score int")
    got = {r.name: (r.quota_reached, r.complete, r.skip) for r in I.crawl_status(ratings, users, quota=2).collect()}
    # a: rated 2 (not > 2), all 3 >= 3 -> complete; b: rated 3 > 2, all 3 < 4
    assert got == {"a": (False, True, True), "b": (True, False, True)}
    got = {r.name: r.skip for r in I.crawl_status(ratings, users, quota=2, get_all=True).collect()}
    assert got == {"a": True, "b": False}


def test_active_users_and_export(spark):
    rows = [(1, i, 1) for i in range(4)] + [(2, i, 1) for i in range(3)] + [(1, 9, 0)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, score int")
    assert [r.user_id for r in R.active_users(df, 3).collect()] == [1]   # 5 rows > 3; 3 rows not
    got = [tuple(r) for r in R.export_ratings(df, 3, 2).orderBy("item_id").collect()]
    assert got == [(1, 0, 1), (1, 1, 1)]


def test_new_rows_and_upsert_laws(spark):
    old = spark.createDataFrame([(1, [1, 2]), (2, [3])], "user_id int, item_ids array<int>")
    new = spark.createDataFrame([(2, [4, 5]), (3, [])], "user_id int, item_ids array<int>")
    once = S.upsert_user_recs(old, new)
    got = {r.user_id: r.item_ids for r in once.collect()}
    assert got == {1: [1, 2], 2: [4, 5], 3: []}
    twice = {r.user_id: r.item_ids for r in S.upsert_user_recs(once, new).collect()}
    assert twice == got
    assert once.groupBy("user_id").count().filter("count > 1").count() == 0


def test_new_ratings_dedup(spark):
    stored = spark.createDataFrame([("u1", 1)], "item_url string, user_id int")
    batch = spark.createDataFrame([("u1", 1, 3), ("u2", 1, 5), ("u2", 1, 4), ("u3", 2, 1)],
                                  "item_url string, user_id int, score int")
    got = sorted(tuple(r) for r in I.new_ratings(batch, stored, order_cols=["score"]).collect())
    assert got == [("u2", 1, 4), ("u3", 2, 1)]


def test_user_totals_upsert(spark):
    users = spark.createDataFrame([(1, "a b", 5, "h1"), (7, "c", 2, "h7")],
                                  "user_id int, name string, declared_total int, home_url string")
    prof = spark.createDataFrame([("a-b", 9, "x"), ("z", 4, "hz"), ("y", 1, "hy")],
                                 "user_name string, declared_total int, home_url string")
    got = {r.name: (r.user_id, r.declared_total) for r in S.upsert_user_totals(users, prof).collect()}
    assert got == {"a b": (1, 9), "c": (7, 2), "y": (8, 1), "z": (9, 4)}


def test_snapshot_round_trip(spark, tmp_path):
    new = spark.createDataFrame([(1, [1])], "user_id int, item_ids array<int>")
    p1 = S.upsert_snapshot(spark, None, new, "user_id", str(tmp_path))
    p2 = S.upsert_snapshot(spark, p1, spark.createDataFrame([(2, [2])], "user_id int, item_ids array<int>"),
                           "user_id", str(tmp_path))
    assert p1 != p2 and spark.read.parquet(p2).count() == 2 and spark.read.parquet(p1).count() == 1


def test_null_violations_and_conform(spark):
    from recsmith.schemas import USERS, conform, null_violations, rejects
    df = spark.createDataFrame([(1, "a", 3, "h"), (2, None, 1, "h"), (None, "c", 0, "h")],
                               "user_id int, name string, declared_total int, home_url string")
    r = null_violations(df, USERS).first()
    assert (r.user_id_nulls, r.name_nulls, r.declared_total_nulls, r.n_rows) == (1, 1, 0, 3)
    assert conform(df, USERS).count() == 1
    assert rejects(df, USERS).count() == df.count() - 1
