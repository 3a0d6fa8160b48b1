"""The registered queries of this package that have SQL, against that SQL."""

import pytest

from feedloom.llm.queries import QUERIES, SQL
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert compare(spark, connect(SF), SF, name) == []


def test_names():
    assert set(SQL) <= set(QUERIES)
