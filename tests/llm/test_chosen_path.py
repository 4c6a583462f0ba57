"""Chosen-path near-dedup, and the units both set joins share, against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from recsmith.llm import chosen_path, setunits

from . import brute
from .test_copies import variants


def shingles(text):
    w = brute.spaced(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)])


def groups(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    kinds = {}
    for i, s in enumerate(sets):
        kinds.setdefault(s, []).append(i)
    kinds.pop(frozenset(), None)
    known = list(kinds)
    for a, x in enumerate(known):
        for i in kinds[x]:
            root[find(i)] = find(kinds[x][0])
        for y in known[:a]:
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                root[find(kinds[x][0])] = find(kinds[y][0])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), c, d == c) for i, ((d, _), s) in enumerate(zip(rows, sets))
                   for c in [least.get(find(i))]), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def loose(seed, n, size=150, changes=5):
    """Near copies of one text, each pair linked or not by the number of words changed; half quote it only."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    base = rng.choices(words, k=size)
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own if i % 3 else own[:60] + rng.choices(words, k=60)))
    return list(enumerate(out))


def test_equals_brute_force(table_of):
    rows = variants(7, 60, 6, hot=90)
    assert rows_of(chosen_path.join_components(table_of(rows))) == groups(rows)


def test_odd_rows(table_of, odd_rows):
    assert rows_of(chosen_path.join_components(table_of(odd_rows))) == groups(odd_rows)
    assert rows_of(chosen_path.join_components(table_of([]))) == []


@pytest.mark.parametrize("unit", [20, 60])
def test_large_nodes_branch_and_keep_links(table_of, monkeypatch, unit):
    monkeypatch.setattr(setunits, "UNIT_ROWS", unit)
    rows = loose(3, 300)
    assert rows_of(chosen_path.join_components(table_of(rows))) == groups(rows)


def test_recall_of_the_trees():
    """The share of pairs at the limit that no tree brings together in its first node."""
    rng = np.random.default_rng(1)
    lost = 0
    for _ in range(400):
        x = rng.integers(0, 2 ** 63, 200, np.uint64)
        y = np.concatenate([x[:184], rng.integers(0, 2 ** 63, 16, np.uint64)])  # 184 / 216 = 0.852
        a, b = (chosen_path.minwise(s)[:chosen_path.TREES * chosen_path.BRANCH] for s in (x, y))
        lost += not (a == b).any()
    assert lost == 0


@given(st.integers(0, 10 ** 6), st.integers(2, 40), st.booleans())
@settings(max_examples=40, deadline=None)
def test_units_lose_no_link(seed, n, cross):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2 ** 63, rng.integers(1, 300), np.uint64)
    members = [np.unique(np.concatenate([base[rng.random(len(base)) > rng.choice([0, .05, .1, .3])],
                                         rng.integers(0, 2 ** 63, rng.integers(0, 20), np.uint64)])) for _ in range(n)]
    members = [m if len(m) else base[:1] for m in members]
    comp = rng.integers(0, n, n)
    side = rng.integers(0, 2, n) if cross else np.zeros(n, np.int64)
    size = np.array([len(m) for m in members])
    sets = [set(m.tolist()) for m in members]
    shared = np.array([[len(x & y) for y in sets] for x in sets])
    assert ((setunits.overlaps(members) == shared) | np.eye(n, dtype=bool)).all()
    link = 185 * shared >= 85 * (size[:, None] + size[None])
    if side.min() != side.max():
        link &= side[:, None] != side[None]
    grp = setunits.may_link(np.array([setunits.bitmap(m) for m in members], object), size, comp, side, 85)
    i, j = np.nonzero(link & (comp[:, None] != comp[None]))
    assert (grp[i] >= 0).all() and (grp[i] == grp[j]).all()
    root = {int(c): int(c) for c in comp}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, j in zip(*np.nonzero(link)):
        a, b = sorted((find(int(comp[i])), find(int(comp[j]))))
        root[b] = a
    a, b = setunits.linked_components(members, comp, side, 85)
    got = {int(c): int(c) for c in comp} | {int(y): int(x) for x, y in zip(a, b)}
    assert got == {c: find(c) for c in got}


def test_all_parts_hold_every_pair_of_two_components_once(spark, monkeypatch):
    monkeypatch.setattr(setunits, "UNIT_ROWS", 10)
    rng = random.Random(5)
    rows = [(1, i, 5, 7 if i < 60 else rng.choice([1, 2, i])) for i in range(100)] + [(2, i, 5, i % 2) for i in range(9)]
    got = setunits.all_parts(spark.createDataFrame(rows, "node long, fp long, n long, comp long")).collect()
    units = {}
    for r in got:
        units.setdefault((r.node, r.p, r.q), []).append((r.fp, r.side, r.comp))
    seen = {}
    for (node, p, q), own in units.items():
        assert len(own) <= 2 * 10 * 3
        for i, (a, s, c) in enumerate(own):
            for b, t, d in own[:i]:
                if c != d and (p == q or s != t):
                    pair = node, min(a, b), max(a, b)
                    seen[pair] = seen.get(pair, 0) + 1
    want = {(x[0], min(x[1], y[1]), max(x[1], y[1])) for x in rows for y in rows if x[0] == y[0] and x[3] != y[3]}
    assert seen == dict.fromkeys(want, 1)
