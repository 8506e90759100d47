"""Every registered query against its DuckDB oracle, and the smoke entry."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle import compare, duck

# the optional operators have tests of their own
NAMES = sorted(n for n in E.queries() if not re.match(r"op[0-9]+_|pipeline$", n))


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    assert compare(df, con, E.oracle_sql()[name]) == []


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 7 and {r.n_rows for r in rows} == {150}
