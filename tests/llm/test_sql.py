"""Queries against the SQL that states their results."""

import pytest

from ordermill.llm import queries as text_queries
from tests import oracle
from tests.conftest import TEST_DATA

SQL = text_queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(TEST_DATA)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, name):
    assert oracle.differences(text_queries.queries()[name](spark, TEST_DATA), duck, SQL[name]) == []
