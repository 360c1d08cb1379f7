"""Every registered query against its DuckDB oracle at sf0.001 (the driver uses sf0.01)."""

import pytest

import __spark_entry__ as E
from orderlake import oracle, registry
from tools.oracle_check import TABLES, rows_of
from tests.conftest import SF_TINY

# the queries of this library proper; those of the optional subpackage are tested with it
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["region", "month", "orders", "net_revenue"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())
    assert len(QUERIES) == 61


@pytest.fixture(scope="module")
def duck():
    import duckdb
    import os
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_TINY}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_TINY).toPandas()
    want = duck.sql(ORACLE[name]).df()
    gc, gr = rows_of(got, False)
    wc, wr = rows_of(want, False)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
