"""Decontamination, licenses, packing and token counts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from recsmith.llm import decontam, license_scan, packing, pretokens, token_counts

from . import brute

ODD = ["", None, "<|endoftext|>", "a<|endoftext|>b", "<|startoftext|> x", "it's we'll I'VE 's", "naïve ÉTÉ straße",
       "tabs\tand\n\nlines  \r\n x", "日本語 текст ﬁ Ⅷ ² ½", "é combining", "emoji 😀😀", "a b c",
       "1234567890 12 3", "_under_score_", "x" * 3000, "İstanbul ŉ", "'S 'T", "\u0000 nul \x1c fs", "KK"]


def library(name):
    return Tokenizer.from_file(pretokens.default_path(name))


def test_token_counts(table_of, odd_rows):
    rows = list(enumerate(ODD)) + odd_rows
    tok = library("word_bpe_49k.json")
    want = sorted((str(d), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    got = token_counts.token_counts(table_of(rows), pretokens.default_path(pretokens.WORD_BPE)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert not token_counts.token_counts(table_of([]), pretokens.default_path(pretokens.WORD_BPE)).collect()


def check_pieces(pieces, want, capacity=1024):
    """want: (doc_id, ids) rows. Each id is in one piece, sequences are gapless, little is padded."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id, r.doc_tokens].append(r)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    rows = defaultdict(list)
    for d, ids in want:
        rows[d, len(ids)].append(np.array(ids, "<u4"))
    assert rows.keys() == by_doc.keys()
    for key, texts in rows.items():
        left = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[key])
        if len(texts) == 1:
            assert [s for s, _, _ in left] == np.cumsum([0] + [n for _, n, _ in left])[:-1].tolist()
            assert all(zlib.crc32(texts[0][s:s + n].tobytes()) == c for s, n, c in left)
        assert sum(n for _, n, _ in left) == sum(map(len, texts))
    return by_seq


def test_packing(table_of, odd_rows):
    rows = list(enumerate(ODD, 200)) + odd_rows
    tok = library("byte_bpe_50k.json")
    want = [(d, tok.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in rows]
    docs = table_of(rows).coalesce(1)
    seqs = check_pieces(packing.pack(docs, pretokens.default_path(pretokens.BYTE_RANKS)).collect(), want)
    total = sum(len(i) for _, i in want)
    assert len(seqs) <= -(-total // 1024)  # one group: less than one sequence of padding
    check_pieces(packing.pack(docs, pretokens.default_path(pretokens.BYTE_RANKS), group_tokens=500).collect(), want)
    assert not packing.pack(table_of([]), pretokens.default_path(pretokens.BYTE_RANKS)).collect()


def test_packing_of_very_long_runs(spark):
    texts = [" " * 10 ** 6, "\n" * 10 ** 6, "^" * 10 ** 6, "a" * 10 ** 6, "word " * 50 + " \n" * 200_000 + "end", " "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = pretokens.library(pretokens.default_path("byte_bpe_50k.json"))
    want = [(i, tok.encode(t, add_special_tokens=False).ids + [0]) for i, t in enumerate(texts)]
    check_pieces(packing.pack(docs, pretokens.default_path(pretokens.BYTE_RANKS)).collect(), want)


def test_assign_balances_cost():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 700, 500)
    pieces, cost = packing.assign(lengths, 1024)
    fill = defaultdict(int)
    for i, start, n, seq, off in pieces:
        fill[seq] += n
    assert sum(fill.values()) == lengths.sum() and max(fill.values()) <= 1024
    assert len(cost) == -(-lengths.sum() // 1024)
    plain = np.zeros(len(cost))  # the same documents in the order given, next fit with cuts
    at = 0
    for n in lengths:
        while n:
            k = min(n, 1024 - at % 1024)
            plain[at // 1024] += k + k * k / 1024
            at, n = at + k, n - k
    assert cost.std() < 0.6 * plain.std()


@pytest.fixture()
def corpus():
    rng = random.Random(11)
    vocab = [f"t{i}" for i in range(300)] + ["the", "of", "é"] * 60
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([4, 9, 10, 11, 30])))) for i in range(40)]
    items += [(50, items[0][1]), (51, None), (52, ""), (53, "?!"), (54, "The")]
    docs = []
    for i in range(150):
        w = rng.choices(vocab, k=rng.randint(0, 80))
        if i % 3 == 0:
            own = rng.choice(items[:40])[1].split()
            cut = rng.randint(0, max(0, len(own) - 10))
            w[10:10] = own[cut:cut + 14]
        docs.append((i, ", ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    return docs, items


def test_decontaminate(spark, table_of, odd_rows, corpus):
    docs, items = corpus
    docs += odd_rows
    bench = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, terms string")
    got = decontam.decontaminate(table_of(docs), bench).collect()
    import hashlib
    found = brute.windows(items)
    want = []
    for d, t in docs:
        n, hit, own = brute.contamination(t, found)
        want.append((str(d), n, hit, len(own), hashlib.sha256(",".join(own).encode()).hexdigest(), hit > 0))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)
    kept = decontam.clean(table_of(docs), bench)
    assert kept.columns == table_of(docs).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(w[0] for w in want if not w[5])
    assert decontam.decontaminate(table_of([]), bench).count() == 0
    assert not decontam.decontaminate(table_of(docs), bench.where("item_id < 0")).where("contaminated").collect()


def test_matches_without_broadcast(spark, table_of, odd_rows, monkeypatch):
    """Phrase and proximity matches equal brute force where every join shuffles and hot terms are salted."""
    rng = random.Random(5)
    vocab = [*"abcdefghijklmno", *["the"] * 8]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 4, 6])))) for i in range(12)] + [(20, "zz a"), (21, None)]
    docs = odd_rows[:14] + [(100 + i, " ".join(rng.choices(vocab, k=rng.randint(0, 25)))) for i in range(40)] * 2
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    got = decontam.matches(table_of(docs), decontam.test_windows(bench, 4), 4, proximity=True)
    got = {(str(r.doc_id), r.row_hash, tuple(r.terms), r.start, r.kind) for r in got.collect()}
    hashes = {(str(r.doc_id), r.text): r.h for r in table_of(docs).selectExpr("doc_id", "text", "xxhash64(text) h").collect()}
    assert got == {(str(d), hashes[str(d), t], *m) for d, t in docs for m in brute.term_matches(
        t, brute.windows(items, 4), [t for _, t in docs], 4)}
    assert {k[4] for k in got} == {"phrase", "proximity"}


def test_proximity(spark, table_of):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    docs = table_of([(1, "x a b c d e f g h i j y"), (2, "x j i h g f e d c b a"), (3, "a b c d e f g h i y")])
    got = decontam.matches(docs, decontam.test_windows(bench), proximity=True).collect()
    assert sorted((r.doc_id, r.kind) for r in got) == [(1, "phrase"), (2, "proximity")]
    assert [r.start for r in got if r.kind == "phrase"] == [1]


def test_proximity_query_finds_reordered_passages(spark, tmp_path):
    from recsmith.llm import queries

    terms = "zero one two three four five six seven eight nine".split()
    texts = ["x " + " ".join(terms) + " y", "x " + " ".join(terms[::-1]) + " y", " ".join(terms[:9]) + " y", None]
    spark.createDataFrame([*enumerate(texts), (None, texts[1])], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, " ".join(terms)), (6, " ".join(terms))], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op4_proximity"](spark, str(tmp_path)).collect()}
    exact = queries.QUERIES["op4_decontamination"](spark, str(tmp_path))
    assert {r.doc_id: r[:-2] for r in got.values()} == {r.doc_id: tuple(r) for r in exact.collect()}
    assert {d: (r.contaminated, r.n_near_windows, r.n_near_items) for d, r in got.items()} == {
        0: (True, 0, 0), 1: (False, 1, 2), 2: (False, 0, 0), 3: (False, 0, 0), None: (False, 1, 2)}


def test_licenses(spark, table_of, odd_rows):
    mit = license_scan.KNOWN[7][1]
    rows = odd_rows + [(50, "Copyright (c) 2020 A. Author\n\n" + mit.upper()), (51, "Released under the mit-licence!!"),
                       (52, "x y\nReleased under the MIT License.\n* Licensed under CC BY 4.0\nz"),
                       (53, "Released under the MIT License and more"), (54, "(c) nobody")]
    got = {r.doc_id: (r.license, r.n_license_lines, r.line_licenses)
           for r in license_scan.scan(table_of(rows), license_scan.default_known(spark)).collect()}
    assert got[50][0] == "MIT" and got[51] == ("MIT", 1, "MIT") and got[52] == (None, 2, "CC-BY-4.0,MIT")
    assert got[53] == got[54] == got[1] == got[15] == (None, 0, "")
    assert license_scan.scan(table_of(rows), license_scan.default_known(spark)).count() == len(rows)
    assert license_scan.scan(table_of([]), license_scan.default_known(spark)).count() == 0
