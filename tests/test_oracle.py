"""Every query against the same query in SQL, on the supplied tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from compare import compare, open_tables
from tidemark import oracle, registry

QUERIES, SQL = registry.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return open_tables(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    compare(QUERIES[name](spark, sf_dir), con, SQL[name])


def test_entry(spark):
    assert driver.entry(spark).count() > 0
