"""Every query with SQL gives the same rows on DuckDB, on whole tables."""

import pytest

import __spark_entry__ as contract
from tabprep.plans import registry
from tests.oracle import connect, differences

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_compares_models(spark):
    rows = {r["model"]: r for r in contract.entry(spark).collect()}
    assert set(rows) == {"mean", "median", "line"}
    assert len({r["n_rows"] for r in rows.values()}) == 1
