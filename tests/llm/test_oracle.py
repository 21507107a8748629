"""The corpus queries that SQL can express, against that SQL on the supplied tables."""

import pytest

import __spark_entry__ as driver
from compare import compare, open_tables
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return open_tables(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])


def test_everything_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
