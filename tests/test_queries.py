"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, multiset

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cost_net" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) > 0
        return
    cur = con.execute(sql)
    drows = cur.fetchall()
    dnames = [d[0] for d in cur.description]
    sc, sr = multiset(df.columns, rows)
    dc, dr = multiset(dnames, drows)
    assert sc == dc
    assert len(rows) == len(drows)
    assert sr == dr
