"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from recsmith.llm import ranked_search as rs

from . import brute


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text))


def ranking(docs, items, k=20):
    words = [(d, terms(t)) for d, t in docs]
    counts = [(d, len(w), Counter(w)) for d, w in words]
    n_docs, n_terms = sum(1 for _, n, _ in counts if n), sum(n for _, n, _ in counts)
    df = Counter(t for _, _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in items:
        scores = []
        for d, n, c in counts:
            s = sum(weight[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // n_terms)))
                    for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item_id, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def items_of(spark):
    return lambda rows: spark.createDataFrame(
        [(i, t, "x", 1, 2, 3) for i, t in rows], "item_id long, text string, doc_id string, rank int, item int, term int")


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    draw = lambda k: [words[min(299, int(rng.paretovariate(0.7)) - 1)] for _ in range(k)]
    docs = [(i, " ".join(draw(rng.randint(1, 80)))) for i in range(n)]
    docs += [(n + i, docs[0][1]) for i in range(40)]  # ties beyond k
    items = [(i, " ".join(draw(rng.randint(1, 30)))) for i in range(12)] + [(50, docs[0][1]), (51, docs[3][1] + " w299")]
    return docs, items


@pytest.mark.parametrize("rows", [rs.SHARD_ROWS, 150, 7])
def test_equals_brute_force(table_of, items_of, rows):
    docs, items = corpus(1, 700)
    index = rs.build_index(table_of(docs), shard_rows=rows)
    assert rows_of(rs.search(index, items_of(items))) == ranking(docs, items)


def test_blocks_of_items_and_token_bound(table_of, items_of):
    docs, items = corpus(2, 120)
    index = rs.build_index(table_of(docs), shard_tokens=200)
    assert rows_of(rs.search(index, items_of(items), k=5, block_terms=40)) == ranking(docs, items, 5)


def test_odd_rows(table_of, items_of, odd_rows):
    items = [(1, None), (2, ""), (3, "no such_term9"), (4, "WORD word id"), (4, "WORD word id"), (4, "another"),
             (None, "été Éa x 😀"), (5, odd_rows[7][1]), (2 ** 62 + 1, odd_rows[12][1])]
    got = rs.rank(table_of(odd_rows), items_of(items))
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows_of(got) == ranking(odd_rows, items)
    assert rows_of(rs.rank(table_of([]), items_of(items))) == []
    assert rows_of(rs.rank(table_of([(1, None), (2, "..")]), items_of(items))) == []
    assert rows_of(rs.rank(table_of(odd_rows), items_of([]))) == []


def lists_of(doc, term, length):
    found, at, docs, tf = rs.inverted(doc, term)
    columns = rs.packed(at, docs, tf, length)
    out = {}
    for i, t in enumerate(found):
        row = {c: bytes(columns[c][1])[columns[c][0][i]:columns[c][0][i + 1]] for c in rs.PARTS}
        out[int(t)] = (row | {"n": int(at[i + 1] - at[i])}, docs[at[i]:at[i + 1]], tf[at[i]:at[i + 1]])
    return out


@given(st.integers(0, 10 ** 6), st.integers(1, 400), st.sampled_from([10, 70_000]))
@settings(max_examples=30, deadline=None)
def test_lists_keep_their_postings_and_bounds(seed, n_docs, spread):
    rng = np.random.default_rng(seed)
    own = np.sort(rng.choice(n_docs * spread, n_docs, replace=False))  # document numbers with wide gaps
    n = rng.integers(0, 12, n_docs)
    n[rng.integers(0, n_docs)] = 700  # one term several hundred times
    doc = np.repeat(own, n)
    term = np.where(rng.random(len(doc)) < 0.7, 0, rng.integers(0, 9, len(doc)))
    length = np.zeros(n_docs * spread, np.int64)
    length[own] = n + rng.integers(0, 50, n_docs)
    for row, docs, tf in lists_of(doc, term, length).values():
        x = rs.List(row, 3, n_docs, max(1, int(length.sum())))
        got, occ = x.unpack(np.arange(len(x.first)))
        assert (got == docs).all() and (occ == tf).all()
        score = 3 * rs.share(tf, length[docs], n_docs, max(1, int(length.sum())))
        top = np.maximum.reduceat(score, np.arange(0, len(docs), rs.BLOCK))
        assert (x.block_max >= top).all()
        some = np.unique(rng.integers(0, len(x.first), 2))
        part, _ = x.unpack(some)
        assert (part == np.concatenate([docs[b * rs.BLOCK:(b + 1) * rs.BLOCK] for b in some])).all()
        assert (x.block_of(docs) == np.arange(len(docs)) // rs.BLOCK).all()


def test_blocks_are_rejected_without_unpacking():
    rng = np.random.default_rng(4)
    n_docs = 20_000
    rare = np.arange(100, 130)  # the documents sought hold rare terms; a frequent one is in every third document
    doc = np.concatenate([np.repeat(rare, 6), np.arange(0, n_docs, 3)])
    term = np.concatenate([np.tile(np.arange(1, 7), len(rare)), np.zeros(len(range(0, n_docs, 3)), np.int64)])
    length = np.bincount(doc, minlength=n_docs) + rng.integers(1, 9, n_docs)
    weight = {0: 2} | {t: 9000 for t in range(1, 7)}
    lists = {t: rs.List(row, weight[t], n_docs, int(length.sum()))
             for t, (row, _, _) in lists_of(doc, term, length).items()}
    found, score = rs.best_of([(1, x) for x in lists.values()], length, np.arange(n_docs), 20, n_docs, int(length.sum()))
    assert len(found) == 20 and lists[0].unpacked <= 2 < len(lists[0].first)
    full = np.zeros(n_docs, np.int64)
    for x in lists.values():
        d, s = rs.scored(x, np.arange(len(x.first)), length, n_docs, int(length.sum()))
        full[d] += s
    want = np.lexsort((np.arange(n_docs), -full))[:20]
    assert (found == want).all() and (score == full[want]).all()
