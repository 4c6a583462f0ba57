"""Tables with a commit log: interleaved writers, partial rewrites, batches written once."""

import pytest
from pyspark.sql import functions as F

from recsmith.sources import commits

RECS = "user_id int, recs string"


def recs(spark, rows):
    return spark.createDataFrame(rows, RECS)


def rows_of(table, version=None):
    return sorted(tuple(r) for r in table.rows(version).collect())


def test_two_writers_lose_nothing_and_give_no_id_twice(spark, tmp_path):
    a, b = (commits.Table(spark, str(tmp_path / "t"), "id long, who string") for _ in "ab")
    asked = []

    def two_more(who):
        def change(old):
            asked.append(who)
            if who == "a" and asked.count("a") == 1:
                b.write(two_more("b"))  # the other writer commits between this one's read and its commit
            first = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
            return spark.createDataFrame([(first + 1, who), (first + 2, who)], "id long, who string")
        return change

    assert a.current().number == 0 and rows_of(a) == []
    version = a.write(two_more("a"))
    assert asked == ["a", "b", "a"] and version.number == 2 == b.current().number
    assert rows_of(b) == [(1, "b"), (2, "b"), (3, "a"), (4, "a")]
    assert rows_of(a, a._read(1)) == [(1, "b"), (2, "b")]  # a reader keeps its version


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    t = commits.Table(spark, str(tmp_path / "t"), RECS, key="user_id", buckets=8)
    t.upsert(recs(spark, [(i, "old") for i in range(40)]))
    before = dict(t.current().parts)
    t.upsert(recs(spark, [(7, "new"), (100, "new")]))
    after = dict(t.current().parts)
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and len(after) == len(t.current().parts)
    want = {i: "old" for i in range(40)} | {7: "new", 100: "new"}
    assert rows_of(t) == sorted(want.items())


def test_interleaved_upserts_keep_both(spark, tmp_path):
    a, b = (commits.Table(spark, str(tmp_path / "t"), RECS, key="user_id", buckets=4) for _ in "ab")
    a.upsert(recs(spark, [(i, "old") for i in range(9)]))
    read = a.current
    a.current = lambda: (got := read(), b.upsert(recs(spark, [(3, "b"), (50, "b")])) if got.number == 1 else None)[0]
    assert a.upsert(recs(spark, [(3, "a"), (4, "a")])).number == 3
    a.current = read
    assert rows_of(a) == sorted(({i: "old" for i in range(9)} | {50: "b", 3: "a", 4: "a"}).items())


def test_a_batch_is_written_once(spark, tmp_path):
    t = commits.Table(spark, str(tmp_path / "t"), RECS)
    for _ in range(2):  # the second is a retry of a batch that failed after its commit
        t.write(lambda old: recs(spark, [(1, "x")]), batch="epoch-5")
    t.write(lambda old: recs(spark, [(2, "y")]), batch="epoch-6")
    assert rows_of(t) == [(1, "x"), (2, "y")] and t.current().batches == {"epoch-5": 1, "epoch-6": 2}


def test_a_taken_number_is_a_conflict(spark, tmp_path):
    t = commits.Table(spark, str(tmp_path / "t"), RECS)
    t._commit(commits.Version(1))
    with pytest.raises(commits.Conflict):
        t._commit(commits.Version(1))
    assert t.current() == commits.Version(1)
