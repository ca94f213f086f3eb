"""Every registered query agrees with its DuckDB counterpart on the smallest tables."""

import pytest

import __spark_entry__ as contract
from exactsync.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 1500
