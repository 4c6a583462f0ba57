"""One key holds a third of the rows: results must stay whole and exact."""

import random

from hypothesis import given, settings, strategies as st

from recsmith.operators import ingest as I, prefix as PX, ratings as R


def hot_ratings(spark, n=3000, seed=9):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if i % 3 == 0 else rnd.randint(2, 60)
        rows.append((user, rnd.randint(0, 400), rnd.randint(0, 5)))
    # one row per (user, item), highest score, as ratings_base gives
    best = {}
    for u, it, s in rows:
        best[(u, it)] = max(best.get((u, it), -1), s)
    return [(u, it, s) for (u, it), s in best.items()]


def test_export_with_hot_user(spark):
    rows = hot_ratings(spark)
    df = spark.createDataFrame(rows, "user_id long, item_id long, score int").repartition(8)
    got = sorted(tuple(r) for r in R.export_ratings(df, 30, 50).collect())
    counts = {}
    for u, _, _ in rows:
        counts[u] = counts.get(u, 0) + 1
    want = []
    for u in sorted(counts):
        if counts[u] > 30:
            rated = sorted((it, s) for uu, it, s in rows if uu == u and s > 0)[:50]
            want += [(u, it, s) for it, s in rated]
    assert got == sorted(want)


def test_export_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_ratings(spark), "user_id long, item_id long, score int")
    plan = R.export_ratings(df, 30, 50)._jdf.queryExecution().executedPlan().toString()
    # partial WindowGroupLimit below the exchange, final one above it
    assert plan.count("WindowGroupLimit") == 2


def test_quota_pages_hot_user(spark):
    rnd = random.Random(4)
    pages = [(1, p, rnd.randint(0, 15)) for p in range(3000)] + [(2, p, rnd.randint(0, 15)) for p in range(30)]
    pc = spark.createDataFrame(pages, "user_id int, page int, n_rated int").repartition(8)
    st_ = spark.createDataFrame([(1, 5)], "user_id int, n_stored int")
    got = sorted((r.user_id, r.page) for r in I.quota_pages(pc, st_, quota=20000).collect())
    want = []
    for u in (1, 2):
        run = 5 if u == 1 else 0
        for p in range(3000 if u == 1 else 30):
            if run <= 20000:
                want.append((u, p))
            run += dict(((uu, pp), v) for uu, pp, v in pages)[(u, p)]
    assert got == want


def test_dedup_hot_key(spark):
    rows = [("hot", i % 7, f"n{i}") for i in range(5000)] + [("cold", 3, "z")]
    df = spark.createDataFrame(rows, "k string, a int, b string").repartition(8)
    got = {r.k: (r.a, r.b) for r in I.dedup_by_key(df, "k").collect()}
    assert got == {"hot": min((a, b) for k, a, b in rows if k == "hot"), "cold": (3, "z")}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 200), st.integers(0, 9)), min_size=1, max_size=80,
                unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 50))
def test_running_sum_property(spark, rows, chunk):
    df = spark.createDataFrame(rows, "k int, p int, v int")
    got = {(r.k, r.p): r.s for r in PX.running_sum_before(df, "k", "p", "v", "s", chunk=chunk).collect()}
    assert got == {(k, p): sum(v for kk, pp, v in rows if kk == k and pp < p) for k, p, _ in rows}


@settings(max_examples=5, deadline=None)
@given(st.sets(st.text(alphabet="abcdef", min_size=1, max_size=6), min_size=1, max_size=60), st.integers(0, 10**6),
       st.integers(1, 9))
def test_dense_ids_property(spark, keys, base, parts):
    df = spark.createDataFrame([(k,) for k in keys], "item_url string").repartition(parts)
    got = {r.item_url: r.id for r in PX.dense_ids(df, "item_url", base).collect()}
    assert got == {k: base + 1 + i for i, k in enumerate(sorted(keys))}


def test_page_worklist_hot_user_chunks(spark):
    prof = spark.createDataFrame([("hot", "h?", 1001), ("one", "o?", 1), ("zero", "z?", 0)],
                                 "name string, home_url string, page_count int")
    got = I.page_worklist(prof, chunk=100).collect()
    pages = {}
    for r in got:
        pages.setdefault(r.name, []).append(r.page)
    assert sorted(pages["hot"]) == list(range(1001))
    assert pages["one"] == [0] and pages["zero"] == [0]
    inc = {r.page for r in I.page_worklist(prof, chunk=100, inclusive=True).collect() if r.name == "hot"}
    assert inc == set(range(1002))
    assert all(r.start == 15 * r.page and r.url.startswith("h?start=") for r in got if r.name == "hot")
