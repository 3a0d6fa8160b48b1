"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from feedloom.queries import QUERIES, SQL
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) == []


def test_names():
    assert set(SQL) == set(QUERIES)
    assert QUERIES.items() <= queries().items() and SQL.items() <= oracle_sql().items()
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
