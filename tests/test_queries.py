"""Every named query against its SQL."""

import pytest

import __spark_entry__ as entry
from ordermill.plans import registry
from tests import oracle
from tests.conftest import TEST_DATA

LARGER = TEST_DATA.replace("sf0.001", "sf0.01")
QUERIES = registry.queries()
SQL = entry.oracle_sql()
IN_BLOCKS = [
    "q08_product_rank_in_category",
    "q11_value_quartiles",
    "q14_cumulative_revenue_share",
    "q09_order_gaps", "q16_next_order", "q16b_next_order_by_self_join",
]


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(TEST_DATA)


@pytest.fixture(scope="module")
def larger_duck():
    return oracle.connect(LARGER)


def test_each_query_has_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry_has_each_query():
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert oracle.differences(QUERIES[name](spark, TEST_DATA), duck, SQL[name]) == []


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_more_rows_equals_sql(spark, larger_duck, name):
    assert oracle.differences(QUERIES[name](spark, LARGER), larger_duck, SQL[name]) == []


@pytest.mark.parametrize("name", IN_BLOCKS)
def test_query_in_several_blocks_equals_sql(spark, duck, many_blocks, name):
    assert oracle.differences(QUERIES[name](spark, TEST_DATA), duck, SQL[name]) == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows
    values = [r.total_value for r in rows]
    assert values == sorted(values, reverse=True)
