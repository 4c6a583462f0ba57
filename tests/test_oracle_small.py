"""Every registered query runs at sf0.001 and, where it has oracle SQL,
matches DuckDB (columns sorted by name, values order-insensitive)."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of, spark_type  # noqa: E402
from recsmith.sources.tables import TABLE_NAMES  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert {f.name: spark_type(f.dataType) for f in df.schema.fields} == {d[0]: str(d[1]) for d in cur.description}
    assert rows_of(df.columns, rows) == rows_of(dcols, cur.fetchall())
