"""Toxicity, language, quality and language model: edge cases, held-out accuracy, brute force."""

import math
import zlib

import numpy as np
import pytest

from recsmith.llm import language, lm, quality, queries, toxicity

from . import brute

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def learnt(rows, mod, remainder):
    """Ids that are not held out and stand on one row only."""
    return [d for d, _ in rows if d not in (None, 7, 8) and zlib.crc32(str(d).encode()) % mod != remainder]


def test_toxicity_edges(spark, table_of, odd_rows):
    docs = table_of(odd_rows)
    seen = learnt(odd_rows, 5, 0)
    for rows, base in (([], 0.0), ([(seen[0], 1, 1), (None, 1, 0), (seen[1], None, None)], 1.0)):
        got = toxicity.score(docs, toxicity.train(docs, labels_of(spark, rows))).collect()
        assert len(got) == len(odd_rows) and all(abs(r.score - base) < 1e-6 for r in got)
    assert toxicity.clean(docs, labels_of(spark, [])).columns == docs.columns
    assert not toxicity.score(table_of([]), toxicity.train(table_of([]), labels_of(spark, []))).collect()
    held = {str(d): zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in odd_rows if d is not None}
    got = toxicity.score(docs, toxicity.fit(np.zeros(0), [])).collect()
    assert all(r.held_out == held.get(str(r.doc_id), False) for r in got)


def test_toxicity_prior_is_that_of_all_labelled_rows(spark, table_of, monkeypatch):
    rows = [(i, "the same words in every text") for i in range(1000)]
    docs, labels = table_of(rows), labels_of(spark, [(i, 1, int(i % 10 == 0)) for i in range(1000)])
    full = toxicity.score(docs, toxicity.train(docs, labels)).first().score
    monkeypatch.setattr(toxicity, "SAMPLE", 60)  # passed by the clean label, ten times over, and by the toxic one
    got = toxicity.score(docs, toxicity.train(docs, labels)).first()
    assert got.predicted == 0 and abs(got.score - full) < 0.1
    assert toxicity.clean(docs, labels).count() == len(rows)


def test_machine_learns_what_no_sum_of_weights_can():
    rng = np.random.default_rng(0)
    docs, y = [], []
    for _ in range(1200):  # toxic when exactly both or neither of two terms stand together: an interaction alone
        a, b = rng.integers(0, 2, 2)
        docs.append(np.array([1, 2][: 0] + [10] * a + [20] * b + [30 + rng.integers(0, 5)], np.int32))
        y.append(float(a == b))
    old = toxicity.CHI
    try:
        toxicity.CHI = -1.0
        model = toxicity.fit(np.array(y), docs)
    finally:
        toxicity.CHI = old
    right = 0
    for d, t in zip(docs, y):
        s = model["slot"][d]
        s = s[s >= 0]
        z = model["w0"] + toxicity._raw(model["w"], model["v"], np.zeros(len(s), int), s, 1)[0]
        right += (z >= 0) == (t == 1)
    assert right / len(docs) > 0.95


def test_language_edges(spark, table_of, odd_rows):
    langs = {6: "xx", 7: "xx", 9: "yy", 10: "yy", 14: "yy", 11: "zz", 12: "zz"}
    docs = table_of(odd_rows, lang=langs)
    got = language.identify(docs, language.train(docs)).collect()
    assert len(got) == len(odd_rows)
    text = dict((d, t) for d, t in odd_rows if d not in (7, 8, None))
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in text:
            lettered = any(c.isalpha() for c in text[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not lettered) and (lettered or r.score == 0)
    none = table_of(odd_rows)
    assert {r.lang_pred for r in language.identify(none, language.train(none)).collect()} == {"und"}
    assert not language.identify(table_of([]), language.train(table_of([]))).collect()


def test_quality_edges(spark, table_of, odd_rows):
    docs = table_of(odd_rows)
    seen = learnt(odd_rows, 3, 1)
    for rows, base in (([], 0.0), ([(seen[0], 1, 1), (None, 1, 0), (seen[1], None, None)], 1.0)):
        got = quality.score(docs, quality.train(docs, labels_of(spark, rows))).collect()
        assert len(got) == len(odd_rows) and all(r.score == base for r in got)
    y = np.array([0.0, 1.0] * 20)
    texts = [("bad### " * 50 if not k else "a good sentence, number %d. " % i * 9) for i, k in enumerate(y)]
    model = quality.fit(y, texts)
    got = quality.score(docs, model).collect()
    assert model["dictionaries"] and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert not quality.score(table_of([]), model).collect()


def test_quality_learns_from_all_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(0)
    head, *tails = ("".join(map(chr, rng.integers(97, 123, n))) for n in (80_000, 10_000, 10_000))
    y = np.array([0.0, 1.0] * 20)
    texts = [head + tails[int(k)] for k in y]  # the labels differ past 64 KiB only
    model = quality.fit(y, texts)
    sizes = quality.Sizes(model["dictionaries"])
    assert sizes.difference(tails[1]) > 0.1 > -0.1 > sizes.difference(tails[0])
    total = sum(len(t) for t in texts)
    assert len(b"".join(quality.drawn(texts))) == total
    monkeypatch.setattr(quality, "TRAIN_BYTES", total // 4)
    got = quality.drawn(texts)
    assert 0.15 < sum(map(len, got)) / total < 0.35 and any(b.decode() in tails[0] for b in got)


def held_out_rows(spark, name, label):
    got = queries.QUERIES[name](spark, SF).where("held_out")
    table = "documents" if label == "lang" else "labels"
    rows = got.join(spark.read.parquet(f"{SF}/{table}.parquet").select("doc_id", label), "doc_id").collect()
    return rows


def test_language_held_out(spark):
    rows = [r for r in held_out_rows(spark, "op7_language_id", "lang") if r.lang is not None]
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_quality_held_out(spark):
    rows = held_out_rows(spark, "op10_quality", "quality")
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_toxicity_held_out(spark):
    rows = held_out_rows(spark, "op2_toxicity", "toxic")
    score = {k: [r.score for r in rows if r.toxic == k] for k in (0, 1)}
    above = np.mean([a > b for a in score[1] for b in score[0]])
    assert above > 0.8 and np.mean([r.predicted for r in rows if not r.toxic]) < 0.05


@pytest.mark.parametrize("range_bytes", [lm.RANGE_BYTES, 20_000])
def test_language_model(spark, table_of, odd_rows, monkeypatch, range_bytes):
    monkeypatch.setattr(lm, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(lm, "FOLD", 3)
    docs = table_of(odd_rows)
    folder = lm.shared_folder(spark)
    train = docs.where(~lm.held_out(docs.doc_id, 10, 0))
    got = lm.score(docs, folder, lm.build(train, folder)).collect()
    assert len(got) == len(odd_rows)
    learnt = [t for d, t in odd_rows if d is None or zlib.crc32(str(d).encode()) % 10 != 0]
    p, uni, n, v = brute.bigram_model(learnt, lm.discounts)
    want = []
    for d, t in odd_rows:
        x = brute.spaced(t) + [0]
        want.append((str(d), len(x), sum(uni[w] > 0 for w in x),
                     round(sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x), 6),
                     round(sum(math.log10(p(u, w)) for u, w in zip([1] + x[:-1], x)), 6)))
    assert all(r.train_tokens == n for r in got)
    have = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    for a, b in zip(have, sorted(want)):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=1e-9, atol=1e-5)
    assert abs(sum(p("a", w) for w in uni) + p("a", object()) - 1) < 1e-9


def trigram_model(texts, discounts):
    """p(w | a, b) by dictionaries, from its definition."""
    counts = {1: {}, 2: {}, 3: {}}
    for t in texts:
        x = [1, 1] + brute.spaced(t) + [0]
        for i in range(2, len(x)):
            g = tuple(x[i - 2:i + 1])
            counts[3][g] = counts[3].get(g, 0) + 1
    firsts = {}
    for g, c in counts[3].items():
        firsts[g[2]] = firsts.get(g[2], 0) + c * (g[:2] == (1, 1))
        if g[:2] != (1, 1):
            counts[2][g[1:]] = counts[2].get(g[1:], 0) + 1
    counts[2] |= {(1, w): c for w, c in firsts.items() if c}
    for g in counts[2]:
        counts[1][g[1:]] = counts[1].get(g[1:], 0) + 1
    d = {k: discounts(*(sum(c == n for c in counts[k].values()) for n in (1, 2, 3, 4))) for k in counts}
    seen = {}
    for k in counts:
        for g, c in counts[k].items():
            seen.setdefault(g[:-1], []).append((c, d[k][min(c, 3)]))

    def p(*g):
        lower = p(*g[1:]) if len(g) > 1 else 1 / (len(counts[1]) + 1)
        if g[:-1] not in seen:
            return lower
        c = counts[len(g)].get(g, 0)
        return (max(c - d[len(g)][min(c, 3)], 0) + sum(x for _, x in seen[g[:-1]]) * lower) / sum(
            n for n, _ in seen[g[:-1]])

    return p, counts[1]


@pytest.mark.parametrize("range_bytes", [lm.RANGE_BYTES, 40_000])
def test_trigram_model(spark, table_of, odd_rows, monkeypatch, range_bytes):
    monkeypatch.setattr(lm, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(lm, "FOLD", 3)
    assert lm.ORDER >= 3
    docs = table_of(odd_rows)
    folder = lm.shared_folder(spark)
    train = docs.where(~lm.held_out(docs.doc_id, 10, 0))
    got = lm.score(docs, folder, lm.build(train, folder, 3)).collect()
    learnt = [t for d, t in odd_rows if d is None or zlib.crc32(str(d).encode()) % 10 != 0]
    p, words = trigram_model(learnt, lm.discounts)
    want = []
    for d, t in odd_rows:
        x = [1, 1] + brute.spaced(t) + [0]
        want.append((str(d), len(x) - 2, sum(math.log10(p(*x[i - 2:i + 1])) for i in range(2, len(x)))))
    have = sorted((str(r.doc_id), r.n_tokens, r.score) for r in got)
    for a, b in zip(have, sorted(want), strict=True):
        assert a[:2] == b[:2] and np.allclose(a[2], b[2], rtol=1e-9, atol=1e-5)
    for u in ((1, 1), (1, "a"), ("a", "a")):
        assert abs(sum(p(*u, *w) for w in words) + p(*u, object()) - 1) < 1e-9


def test_language_model_without_training(spark, table_of):
    docs = table_of([(1, "a b"), (2, None)])
    folder = lm.shared_folder(spark)
    got = lm.score(docs, folder, lm.build(docs.where("doc_id < 0"), folder)).collect()
    assert {(r.score, r.n_known, r.train_tokens) for r in got} == {(0.0, 0, 0)}


def test_lm_pairs_come_back_and_are_small():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 63, 300, np.uint64)
    for x, rising in ((np.sort(words), True), (words, False), (np.ones(9, np.uint32), False), (np.array([1 << 40, 3]), False),
                      (np.empty(0, np.uint64), True)):
        assert np.array_equal(lm.unsqueezed(lm.squeezed(x, rising), x.dtype), x)
    tokens = words[np.minimum(rng.geometric(0.02, 20_000), 300) - 1]
    before = lm.words_before(tokens, np.array([15_000, 1, 4_999]), 3)
    u = lm.hashed(before)[-1]
    key, at, c = lm.summed(lm.pair_keys(u, tokens, np.empty(0, np.uint64)), np.ones(len(u), np.uint32))
    rows = lm.packed(key, u[at], [x[at] for x in before], tokens[at], lm.edges(3), c.astype(np.uint32))
    back = [np.concatenate(x) for x in zip(*(lm.unpacked(*r[1:4]) for r in rows))]
    got = set(zip(*(x.tolist() for x in (*back, np.concatenate([lm.unsqueezed(r[4], np.uint32) for r in rows])))))
    assert got == set(zip(*(x.tolist() for x in (*(x[at] for x in before), tokens[at], c))))
    assert sum(len(x) for r in rows for x in r[1:]) < 10 * len(at)  # 28 bytes a pair before
