"""Corpus queries that SQL can express, side by side with DuckDB."""

import pytest
from sidebyside import compare, duck

from seispark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_as_sql(spark, con, small, name):
    verdict, rows = compare(spark, con, small, QUERIES[name], ORACLES[name])
    assert verdict is None and rows, verdict
