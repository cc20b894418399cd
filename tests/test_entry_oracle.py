"""The driver contract: entry, queries and their DuckDB twins (sf0.001)."""

import pytest

import __spark_entry__ as se
from prepfold import catalog
from tools.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
SQL = {n: e.sql for n, e in catalog.REGISTRY.items() if e.sql}


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "c_nationkey", "list_year", "report_year", "median_price"]


def test_oracle_keys_are_queries():
    assert set(se.oracle_sql()) <= set(se.queries())
    missing = set(catalog.REGISTRY) - set(SQL)
    assert missing <= {"sample"}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    ok, msg = compare(spark, duck, name, se.queries()[name], SQL[name], SF)
    assert ok, msg
