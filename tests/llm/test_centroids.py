"""Centroid clustering against a brute-force version in Python integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from recsmith.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, q int, distance string, n long, total int"


def brute(rows, k, rounds, dim):
    f32 = lambda x: float(np.float32(x))
    kept = [(v, [math.floor(256 * f32(x)) for x in e]) for v, e in rows
            if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    kept = [(v, [max(-2 ** 27, min(2 ** 27, x)) for x in q]) for v, q in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()
                                        if r[0] is not None else "", r[1]))
    cents = [q for _, q in order[:k]]
    dist = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    for r in range(rounds + 1):
        got = [min((dist(q, c), i) for i, c in enumerate(cents)) for _, q in kept]
        if r == rounds:
            break
        own = defaultdict(list)
        for (_, i), (_, q) in zip(got, kept):
            own[i].append(q)
        cents = [[sum(x) // len(own[i]) for x in zip(*own[i])] if own[i] else c for i, c in enumerate(cents)]
    inertia = defaultdict(int)
    for d, i in got:
        inertia[i] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(v, i, d, inertia[i], sum(inertia.values()), sha[i]) for (v, _), (d, i) in zip(kept, got)]


def frame(spark, rows):
    return spark.createDataFrame([(v, e, 1, 2, 3, "x", 4, 5) for v, e in rows], SCHEMA).repartition(3)


def vectors(seed, n, dim, hot=0):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(7)]
    out = [[x + rng.gauss(0, 0.2) for x in rng.choice(base)] for _ in range(n)] + [base[0]] * hot
    return list(enumerate(out))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("hot", [0, 120])
def test_equals_brute_force(spark, hot):
    rows = vectors(1, 250, 8, hot)
    got = centroids.cluster(frame(spark, rows), n_centroids=12, rounds=4, n_pivots=3, dim=8)
    assert rows_of(got) == sorted(brute(rows, 12, 4, 8), key=str)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(2, 20, 4) + [(100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [1.0, None, 2.0, 3.0]),
                                (105, [nan, 0.0, 0.0, 0.0]), (106, [inf, 0.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0, 4.0]),
                                (None, [1.5, 2.0, 3.0, 4.0]), (3, [9.0, 9.0, 9.0, 9.0]), (3, [9.0, 9.0, 9.0, 9.0]),
                                (107, [1e30, -1e30, 0.0, 0.0]), (2 ** 62 + 1, [0.0, -0.001, 0.001, -0.0])]
    got = centroids.cluster(frame(spark, rows), n_centroids=30, rounds=3, dim=4)
    assert got.count() == 26
    assert rows_of(got) == sorted(brute(rows, 30, 3, 4), key=str)
    few = rows[:3]  # fewer vectors than centroids
    assert rows_of(centroids.cluster(frame(spark, few), dim=4)) == sorted(brute(few, 40, 5, 4), key=str)
    assert rows_of(centroids.cluster(frame(spark, []), dim=4)) == []


@given(st.integers(0, 10 ** 6), st.integers(1, 6), st.integers(1, 12))
@settings(max_examples=40, deadline=None)
def test_bounds_skip_and_keep_the_nearest(seed, n_pivots, k):
    rng = np.random.default_rng(seed)
    near = rng.integers(-3, 3, (80, 5)) + 40 * rng.integers(0, 4, (80, 1))  # many ties and equal vectors
    cents = near[rng.integers(0, 80, k)]
    pivots = centroids.chosen_pivots(cents, n_pivots)
    to = np.stack([np.sqrt(centroids.squared(near, p).astype(float)) for p in pivots], axis=1)
    cluster, d, taken = centroids.nearest(near, to, cents, pivots)
    full = ((near[:, None] - cents[None]) ** 2).sum(-1)
    assert (cluster == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert taken <= full.size


def test_bounds_skip_most_distances_of_clustered_vectors():
    rng = np.random.default_rng(5)
    cents = rng.integers(-2000, 2000, (40, 16))
    q = np.repeat(cents, 30, axis=0) + rng.integers(-20, 20, (1200, 16))
    pivots = centroids.chosen_pivots(cents)
    to = np.stack([np.sqrt(centroids.squared(q, p).astype(float)) for p in pivots], axis=1)
    _, _, taken = centroids.nearest(q, to, cents, pivots)
    assert taken < 0.1 * len(q) * len(cents)
