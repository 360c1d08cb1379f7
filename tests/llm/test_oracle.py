"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from orderlake.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert rows_of(QUERIES[name](spark, SF_SMALL).toPandas(), False) == rows_of(con.sql(ORACLE[name]).df(), False)
