"""Every query against its expected result from DuckDB."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from pairloom.plans.oracle import oracle_queries
from pairloom.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
EXPECTED = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(contract.queries()) and set(EXPECTED) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, EXPECTED[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
