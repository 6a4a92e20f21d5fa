"""Every registered query gives the rows of its SQL in another engine."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(set(queries()) & set(oracle_sql())))
def test_query_matches_sql(name, spark, data, con):
    assert compare(queries()[name](spark, data), oracle_sql()[name], con) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
