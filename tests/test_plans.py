"""Shapes of the physical plans that keep the queries fit for large tables."""

import re

import pytest

from ordermill.plans import analytics, report
from ordermill.plans.registry import queries
from ordermill.sources import testdata
from tests.conftest import TEST_DATA

# Queries that end with reading what they wrote have no plan to look at.
QUERIES = [n for n in queries() if not n.startswith(("stored_", "csv_", "bucketed_"))]


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")


@pytest.mark.parametrize("name", QUERIES)
def test_plan_holds_no_bottleneck(spark, no_broadcast, name):
    text = plan(queries()[name](spark, TEST_DATA))
    for bad in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "InPandas", "InArrow"):
        assert bad not in text
    # One task sees all rows only after an aggregate or a limit.
    lines = text.splitlines()
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search("Aggregate|LocalLimit|TakeOrdered", lines[at + 1]), lines[at + 1]


@pytest.mark.parametrize("question", [analytics.order_gaps, analytics.next_order])
def test_orders_move_once_for_customer_windows_and_order(spark, question):
    text = plan(question(testdata.clean(spark, TEST_DATA)))
    # One placing serves windows and order; the others move a row per customer and block.
    assert text.count("Exchange rangepartitioning(customer_id") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_order_items_are_summed_before_the_join(spark, no_broadcast):
    t = testdata.clean(spark, TEST_DATA)
    text = plan(analytics.revenue_per_customer(analytics.sums(t)))
    # Items per order, orders, and order values per customer.
    assert text.count("Exchange hashpartitioning") == 3
    assert text.index("SortMergeJoin") < text.rindex("partial_sum(")


def test_scans_read_only_needed_columns(spark):
    t = testdata.clean(spark, TEST_DATA)
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan(analytics.monthly_orders(t))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan(
        analytics.customers_never_delivered(t)
    )


def test_period_reaches_the_scan(spark, settings):
    settings(spark__sql__maxMetadataStringLength="1000")
    t = testdata.clean(spark, TEST_DATA)
    period = report.parse_period("1998-01-01", "1998-01-31")
    text = plan(report.top_products(t, period))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-02-01T00:00)" in text


def test_building_a_period_report_runs_nothing(spark):
    t = testdata.clean(spark, TEST_DATA)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("report", "report")
    try:
        report.period_comparison(t, report.parse_period("1998-01-01", "1998-01-31"))
        report.period_series(t, report.parse_period("1998-01-01", "1998-01-31"), "weekly")
        assert not jobs.getJobIdsForGroup("report")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_running_share_moves_placed_rows_once(spark):
    text = plan(analytics.cumulative_revenue_share(testdata.clean(spark, TEST_DATA)))
    # Rows are placed by range; only the sums, one per block and task, are hashed.
    assert text.count("Exchange hashpartitioning(__block") == 1
    assert "partial_sum" in text.split("Exchange hashpartitioning(__block")[1].splitlines()[1]
    assert text.count("Exchange rangepartitioning") == 1
