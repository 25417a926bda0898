"""Every registered query against its DuckDB oracle on the driver's smallest tables."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from tripgrid import catalog, oracle

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return v  # exact: money means are taken over integer cents in both engines
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF_DIR}/lineitem.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_DIR)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


def test_every_query_has_oracle_or_is_timing():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[0] == "rank"
    assert df.count() >= 0


def test_runtime_settings_are_modifiable(spark):
    """__spark_entry__ applies SQL_CONF to the driver's running session."""
    from tripgrid.session import SQL_CONF, STATIC_CONF

    assert all(spark.conf.isModifiable(k) for k in SQL_CONF)
    assert not any(spark.conf.isModifiable(k) for k in STATIC_CONF)
