"""Every registered query against its SQL on the small tables."""

import pytest

from tallyveil.catalog import QUERIES, SQL

from .conftest import SF


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, same_as_sql, name):
    same_as_sql(QUERIES[name](spark, SF), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_noisy_query(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
