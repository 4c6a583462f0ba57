"""Exact dedup, n-gram join, signature trees and components against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from recsmith.llm import common, components, exact_dedup, ngram_join, setunits, sigtree

from . import brute


def variants(seed, n_groups, size, hot=0):
    """Texts in groups of near copies with some words changed, one of ``hot`` members; ids shuffled."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = rng.choices(words, k=14)
    out = []
    for g in range(n_groups):
        base = rng.choices(words, k=rng.randint(3, 60)) + (shared if g % 2 else [])
        for _ in range(hot if hot and g == 0 else rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 20))):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own))
    rng.shuffle(out)
    return list(enumerate(out, 100))


def test_exact_groups_odd_rows(table_of, odd_rows):
    got = exact_dedup.exact_groups(table_of(odd_rows)).collect()
    groups = defaultdict(list)
    for d, t in odd_rows:
        groups[brute.lower(t)].append(d)
    want = [(d, max((x for x in groups[brute.lower(t)] if x is not None), default=None), len(groups[brute.lower(t)]),
             hashlib.sha256(brute.lower(t).encode()).hexdigest()) for d, t in odd_rows]
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.kept for r in got) == len(groups)
    assert not exact_dedup.exact_groups(table_of([])).collect()


def loose(seed, n, changes=9):
    """Near copies of one text, each pair linked or not by the words changed; a third only quotes it."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    base = rng.choices(words, k=120)
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own if i % 3 else own[:60] + rng.choices(words, k=60)))
    return list(enumerate(out))


@pytest.mark.parametrize("unit", [25, 70])
def test_loose_group_in_large_roots(table_of, monkeypatch, unit):
    monkeypatch.setattr(setunits, "UNIT_ROWS", unit)
    rows = loose(4, 420)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(table_of(rows)).collect())
    assert got == sorted(brute.near_components(rows))


def test_roots_of_one_main_component_unite_where_that_is_less_work(spark):
    rows = [(node, fp, 5, 1 if fp < 20 else fp) for node in (7, 8, 9) for fp in range(24)]  # the same sets: united
    rows += [(11, fp, 5, 2) for fp in range(100, 130)] + [(11, 200, 5, 200)]
    rows += [(12, 100, 5, 2), (12, 101, 5, 2), (12, 300, 5, 300)]  # united it would meet all sets of component 2
    got = ngram_join.united(spark.createDataFrame(rows, "node long, fp long, n long, comp long")).collect()
    assert sorted(tuple(r) for r in got) == sorted([(1, fp, 5, c) for n, fp, _, c in rows if n == 7]
                                                   + [r for r in rows if r[0] in (11, 12)])


def test_one_of_each_keeps_columns(table_of, odd_rows):
    docs = table_of(odd_rows)
    got = exact_dedup.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(brute.lower(r.text) for r in got.collect()) == sorted({brute.lower(t) for _, t in odd_rows})


def test_chunks_are_the_text(spark, table_of, odd_rows):
    import re
    for _, t in odd_rows:
        pattern = exact_dedup.chunk_pattern(20, 50).replace(r"\z", r"\Z")
        assert "".join(re.findall(pattern, t or "")) == (t or "")


def test_chunks_with_one_hash_get_ranks(spark):
    refs = spark.createDataFrame([(1, bytearray(b"a")), (1, bytearray(b"b")), (1, bytearray(b"a")),
                                  (2, bytearray(b"c")), (None, None)], "h long, sha binary")
    got = exact_dedup.conflicting_chunks(refs).collect()
    assert [(r.h, bytes(r.sha), r["rank"]) for r in got] == [(1, b"b", 1)]


@pytest.mark.parametrize("parts", [False, True])
def test_ngram_join(table_of, odd_rows, monkeypatch, parts):
    rows = variants(5, 60, 6, hot=40) + odd_rows
    rows += [(None, t + " tail") for _, t in rows[:40:5]] + [(None, "nobody has an id here at all " * 2 + w) for w in "xyx"]
    if parts:  # many frequent shingles, roots in many parts
        monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", 3)
        monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 10 ** 6)
        monkeypatch.setattr(setunits, "UNIT_ROWS", 20)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.join_components(table_of(rows)).collect())
    want = sorted((str(d), n, c if n else d) for d, n, c in brute.near_components(rows))
    assert got == want


def test_ngram_join_empty_and_kept(table_of):
    assert not ngram_join.join_components(table_of([])).collect()
    rows = variants(9, 12, 4)
    docs = table_of(rows)
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({c for _, _, c in brute.near_components(rows)})


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(2, 90), st.booleans())
def test_trees_lose_no_link(seed, n, two_sides):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(n):
        base = rng.integers(0, 2 ** 63, rng.integers(1, 80)).astype(np.uint64) if not sets or rng.random() < .5 \
            else sets[rng.integers(len(sets))].copy()
        hit = rng.random(len(base)) < .08
        base[hit] = rng.integers(0, 2 ** 63, hit.sum()).astype(np.uint64)
        sets.append(np.unique(base))
    comp = rng.integers(0, max(1, n // 2), n)
    side = rng.integers(0, 2, n) if two_sides else np.zeros(n, np.int64)
    i, j = sigtree.candidates([sigtree.bitmap(s).tobytes() for s in sets], np.array([len(s) for s in sets]), comp, side)
    got = {frozenset(p) for p in zip(i.tolist(), j.tolist())}
    assert len(got) == len(i) and all(len(p) == 2 for p in got)
    both = len(set(side.tolist())) > 1
    for a in range(n):
        for b in range(a):
            o = len(np.intersect1d(sets[a], sets[b]))
            if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o) and comp[a] != comp[b]:
                assert (both and side[a] == side[b]) or frozenset((a, b)) in got


@pytest.mark.parametrize("task_edges", [components.TASK_EDGES, 50])
def test_components_of_chain_and_star(spark, monkeypatch, task_edges):
    monkeypatch.setattr(components, "TASK_EDGES", task_edges)
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain + star + [(5000, 5000), (7001, 7000)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in components.components(edges).collect()}
    want = {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)} | {7000: 7000, 7001: 7000}
    assert got == want
    assert not components.components(edges.where("a < 0")).collect()


def test_a_large_component_takes_many_tasks(spark, monkeypatch):
    largest, forest = [], components._local_forest

    def watched(edges):
        largest.append(max(r[1] for r in edges.groupBy(F.spark_partition_id()).count().collect()))
        return forest(edges)

    monkeypatch.setattr(components, "TASK_EDGES", 200)
    monkeypatch.setattr(components, "_local_forest", watched)
    got = components.components(spark.createDataFrame([(0, i) for i in range(1, 2001)], "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(2001)]
    assert max(largest) < 2 * 200


def test_ascii_lower(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, "doc_id long, text string").select("text", common.ascii_lower(F.col("text")).alias("l"))
    assert all(r.l == (None if r.text is None else brute.lower(r.text)) for r in df.collect())
