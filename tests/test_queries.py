"""Every property query against its oracle SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from parcelwright.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    return con


def normal(values):
    return tuple("NULL" if v is None or v != v else f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in values)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(normal(r) for r in df.select(*columns).collect())
    if name in ORACLES:
        want = duck.execute(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()
        assert got == sorted(map(normal, want))


def test_entry_without_corpus_operators():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
