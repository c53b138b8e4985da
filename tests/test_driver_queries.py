"""Differential tests: every driver query against its DuckDB oracle at sf0.01,
plus the entry smoke check at sf0.001."""

import pytest

import __spark_entry__ as entry
from tessera.plans import driver
from tessera.plans.check import compare, duckdb_connection

from conftest import SF001, SF01

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(driver.QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES[name], SF01, con)
    assert r.ok, f"{name}: spark={r.spark_rows} oracle={r.oracle_rows} {r.detail}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
