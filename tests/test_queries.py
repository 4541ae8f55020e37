"""Every query gives the rows of its SQL."""

import pytest
from compare import compare, duck

from loomlake.plans import analytics, operations, states, tables  # noqa: F401
from loomlake.plans.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf, name):
    compare(spark, con, QUERIES[name], SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
