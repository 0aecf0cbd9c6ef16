"""Every registered query against its oracle on the smallest tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from workload.compare import difference, oracle_connection
from workload.oracle import all_oracles
from workload.queries import all_queries


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())


@pytest.mark.parametrize("key", all_queries())
def test_query_matches_oracle(spark, connection, key):
    assert difference(spark, connection, SMALL, key) is None


def test_flagship_query(spark):
    assert entry.entry(spark).count() == 10
