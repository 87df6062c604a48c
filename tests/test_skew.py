"""Queries over test tables in which one key holds a third of all rows.

One customer has a third of the orders, one order a third of the order items, and one product a
third of them, too.
"""

import duckdb
import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from ordermill.operators import blocks
from ordermill.plans import analytics
from ordermill.schemas import Tables
from tests import oracle
from tests.conftest import TEST_DATA

QUERIES = entry.queries()
SQL = entry.oracle_sql()
CHECKED = [
    name for name in QUERIES
    if name.startswith(("q0", "q1", "orphan", "items_without", "key_", "period_", "cleaned_"))
]

SKEWED = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 7 ELSE o_custkey END "
              "AS o_custkey) FROM source",
    "lineitem": "SELECT * REPLACE ("
                "CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey, "
                "CASE WHEN l_linenumber % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey) "
                "FROM source",
    "customer": "SELECT * FROM source",
    "part": "SELECT * FROM source",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("skewed")
    for name, sql in SKEWED.items():
        source = sql.replace("source", f"'{TEST_DATA}/{name}.parquet'")
        duckdb.execute(f"COPY ({source}) TO '{path}/{name}.parquet'")
    return str(path)


@pytest.fixture(scope="module")
def duck(folder):
    return oracle.connect(folder)


def test_tables_are_skewed(duck):
    for table, key in [("orders", "o_custkey"), ("lineitem", "l_orderkey"),
                       ("lineitem", "l_partkey")]:
        top, total = duck.execute(
            f"SELECT max(n), sum(n) FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"
        ).fetchone()
        assert top / total > 0.25


@pytest.mark.parametrize("name", CHECKED)
def test_skewed_query_equals_sql(spark, duck, folder, settings, many_blocks, name):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    assert oracle.differences(QUERIES[name](spark, folder), duck, SQL[name]) == []


def test_a_customer_month_with_a_third_of_the_orders_is_split(spark, many_blocks):
    """No block, and no task, has many more of the orders than the others."""
    days = "date_add(DATE '1995-01-01', CAST(id % 2400 AS INT))"
    orders = spark.range(30_000).selectExpr(
        "id AS order_id", "IF(id % 3 = 0, 7, id % 1500) AS customer_id",
        f"IF(id % 3 = 0, TIMESTAMP_NTZ'1998-05-06 00:00:00', CAST({days} AS TIMESTAMP_NTZ))"
        " AS order_date")
    t = Tables(*[orders.selectExpr("string(customer_id) AS customer_id", "order_date", "order_id")] * 4)
    placed = analytics._in_time(t)
    sizes = sorted(r["count"] for r in placed.groupBy("customer_id", blocks.BLOCK).count().collect())
    assert sizes[-1] < 30_000 / 10
    tasks = sorted(r["count"] for r in placed.repartitionByRange("customer_id", blocks.BLOCK)
                   .groupBy(F.spark_partition_id()).count().collect())
    assert tasks[-1] <= 2 * tasks[len(tasks) // 2]
    expected = orders.filter("customer_id = 7").orderBy("order_date", "order_id").collect()
    for question in (analytics.next_order, analytics.next_order_by_self_join):
        found = question(t).filter("customer_id = '7'").collect()
        assert [r.current_order_id for r in found] == [r.order_id for r in expected]
        assert [r.next_order_id for r in found] == [*[r.order_id for r in expected[1:]], None]
