"""Queries of the subpackage against their SQL."""

import pytest
from compare import compare, duck

from loomlake.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, sf, name):
    compare(spark, con, QUERIES[name], ORACLE_SQL[name], sf)
