"""The queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from tripgrid.llm import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})")
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
