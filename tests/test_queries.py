"""Registered queries against their oracle SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, sf, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], sf) is None
