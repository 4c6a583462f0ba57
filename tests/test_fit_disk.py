"""What fits leave on disk: nothing refers to the ratings' shuffles, stored splits and models go with their fits."""

import os

import numpy as np
import pytest

from recsmith.operators import model as M
from recsmith.plans import model_q
from recsmith.session import CLEANUP_CONF, scratch_dir, written_meanwhile


@pytest.fixture()
def ratings(spark):
    rng = np.random.default_rng(9)
    return spark.createDataFrame([(int(u), int(i), int(1 + (u * i) % 5)) for u in range(60) for i in
                                  rng.choice(50, 15, replace=False)], "userId int, movieId int, rating int")


def factors(model):
    return {r.id: list(r.features) for r in model.userFactors.collect()}


@pytest.fixture()
def left(spark):
    """The kinds of tables that came to the scratch folder and are still there."""
    before = set(os.listdir(scratch_dir(spark)))
    return lambda: {name.rsplit("-", 1)[0] for name in set(os.listdir(scratch_dir(spark))) - before}


def test_factors_of_many_ratings_are_cut_off_from_their_shuffles(spark, ratings, left, monkeypatch):
    """F16: the factors kept all shuffles of all steps on disk as long as the model was in use."""
    small = M.als_fit(ratings, rank=3, seed=4, n_blocks=2)
    monkeypatch.setattr(M, "FEW", 10)
    large = M.als_fit(ratings, rank=3, seed=4, n_blocks=2)
    assert large.userFactors.inputFiles() and large.itemFactors.inputFiles() and large.rank == 3
    a, b = factors(small), factors(large)
    assert a.keys() == b.keys() and all(np.allclose(a[u], b[u], atol=1e-4) for u in a)
    assert M.als_predict(large, spark.createDataFrame([(1, 10 ** 6)], "userId int, movieId int")).count() == 0  # cold start
    assert not {"ratings", "laid"} & left() and "model" in left()


def test_rank_grid_keeps_no_split_and_no_model(spark, ratings, left, monkeypatch):
    """all fits' shuffles of the ratings were on disk at once, and so were their splits."""
    few = {r["rank"]: r.mse for r in M.rank_grid(ratings, (2, 3), 2).collect()}
    clean = spark.conf.get(CLEANUP_CONF)
    monkeypatch.setattr(M, "FEW", 10)
    many = {r["rank"]: r.mse for r in M.rank_grid(ratings, (2, 3), 2).collect()}
    assert few.keys() == many.keys() == {2, 3} and all(np.isclose(few[k], many[k], rtol=1e-3) for k in few)
    assert "grid" in left() and not {"train", "test", "laid", "model"} & left()
    assert spark.conf.get(CLEANUP_CONF) == clean
    train = M.grid_data(ratings).randomSplit([0.8, 0.2], 42)[0]
    again = M.grid_data(ratings.repartition(3)).randomSplit([0.8, 0.2], 42)[0]
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, again.collect()))


def test_users_are_checked_some_at_a_time(spark, ratings, monkeypatch):
    """F16: every rating's copy of its item's factors was on disk at once."""
    monkeypatch.setattr(model_q, "CHECKED", 300)
    monkeypatch.setattr(model_q, "als_input", lambda *_: ratings)
    sizes, solved = [], model_q._solved
    monkeypatch.setattr(model_q, "_solved", lambda some, model: sizes.append(some.count()) or solved(some, model))
    rows = model_q.q_als_fit(spark, "").collect()
    assert len(sizes) == 3 and sum(sizes) == 900 and max(sizes) < 600
    assert sorted((r.user_id, r.solved) for r in rows) == [(u, True) for u in range(60)]


def test_a_table_written_meanwhile_is_gone_afterwards(spark, ratings, left):
    with pytest.raises(ZeroDivisionError):
        with written_meanwhile(ratings, "meanwhile") as stored:
            assert stored.count() == 900 and left() == {"meanwhile"}
            1 / 0
    assert not left()


def test_evaluation_rules_items_out(spark, ratings, monkeypatch):
    """every test user was compared with every item, in five dimensions."""
    asked, recs = [], M.als_recs
    monkeypatch.setattr(M, "als_recs", lambda model, n, bounds, users: asked.append(bounds) or recs(model, n, bounds, users))
    got = {r.k: r.hits for r in M.evaluate_als(ratings, rank=2, ks=(5, 10)).collect()}
    monkeypatch.setattr(M, "als_recs", lambda model, n, bounds, users: recs(model, n, False, users))
    assert got == {r.k: r.hits for r in M.evaluate_als(ratings, rank=2, ks=(5, 10)).collect()} and asked == [True]
