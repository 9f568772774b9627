"""Every registered query against its checking SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from oracle import connect, differences
from shelfwise.plans import oracles, registry

QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_every_query_has_checking_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, small, connection, name):
    assert differences(QUERIES[name](spark, small), connection, ORACLES[name]) is None
