"""Queries with SQL against it, on the smallest tables."""

import pytest
from oracle import compare, duck

from rowlint.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    con = duck(SF)
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) == []
