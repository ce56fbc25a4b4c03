"""Every registered query beside its SQL, on the smallest test data."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in check.TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert check.difference(got, want) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
