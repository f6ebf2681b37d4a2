"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from sidebyside import compare, duck

from seispark.catalog import registry


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_same_as_sql(spark, con, small, name):
    verdict, _ = compare(spark, con, small, registry.QUERIES[name], registry.ORACLES.get(name))
    assert verdict is None, verdict
