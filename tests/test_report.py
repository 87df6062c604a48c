"""Period report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.plans import report
from ordermill.plans.analytics import sums
from tests.tables import customer, item, order, product, rows, tables

JANUARY = report.parse_period("2024-01-01", "2024-01-31")


@pytest.fixture(scope="module")
def shop(spark):
    return tables(
        spark,
        customers=[customer("A"), customer("B")],
        products=[product("P1", "Books", "Same"), product("P2", "Books", "Same"),
                  product("P3", "Home"), product("P4", "Home"), product("P5", "Home")],
        orders=[
            order("O1", "A", "2024-01-01 00:00:00"),
            order("O2", "A", "2024-01-31 23:59:59"),
            order("O3", "UNKNOWN", "2024-01-10 00:00:00"),
            order("O4", "UNKNOWN", "2024-01-11 00:00:00"),   # no items
            order("O5", "B", "2024-02-01 00:00:00"),
            order("O6", "B", "2023-12-31 23:59:59"),
            order("O7", "B", "2023-12-01 00:00:00"),
            order("O8", "B", "2023-11-30 23:59:59"),
        ],
        items=[
            item("I1", "O1", "P1", 1, 10), item("I2", "O1", "P2", 1, 10),
            item("I3", "O2", "P3", 1, 15), item("I4", "O3", "P4", 1, 4.5),
            item("I5", "O3", "P5", -1, -2), item("I6", "O5", "P3", 1, 1000),
            item("I7", "O6", "P3", 1, 50), item("I8", "O8", "P3", 1, 1000),
        ],
    )


def evaluated(spark, period):
    return tuple(spark.range(1).select(F.lit(period.start), F.lit(period.end)).first())


def test_dates(spark):
    assert evaluated(spark, report.previous_period(JANUARY)) == (
        dt.date(2023, 12, 1), dt.date(2023, 12, 31))
    day = report.parse_period(" 2024-03-01", "2024-03-01 ")
    assert evaluated(spark, report.previous_period(day)) == (
        dt.date(2024, 2, 29), dt.date(2024, 2, 29))
    with pytest.raises(ValueError):
        report.parse_period("2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        report.parse_period("02-01-2024", "2024-01-01")


def test_series_has_empty_periods_and_cut_ends(shop):
    period = report.parse_period("2023-11-30", "2024-01-10")
    found = [(str(r[1]), str(r[2]), *r[3:]) for r in rows(
        report.period_series(shop, period, "monthly"))]
    assert found == [
        ("2023-11-30", "2023-11-30", 1, 1000.0, 1), ("2023-12-01", "2023-12-31", 2, 50.0, 1),
        ("2024-01-01", "2024-01-10", 2, 22.5, 2),
    ]
    weeks = rows(report.period_series(shop, JANUARY, "weekly", sums(shop)))
    assert [(str(r[1]), r[3]) for r in weeks] == [
        ("2024-01-01", 1), ("2024-01-08", 2), ("2024-01-15", 0), ("2024-01-22", 0),
        ("2024-01-29", 1)]
    days = rows(report.period_series(shop, JANUARY))
    assert len(days) == 31 and sum(r[3] for r in days) == 4
    assert {(r[1], r[2]) for r in days if r[1] != r[2]} == set()
    with pytest.raises(ValueError):
        report.period_series(shop, JANUARY, "yearly")


def test_report_days_as_columns(spark):
    texts = ["2024-01-02", " 2024-1-2 ", "2024-02-30", "02-01-2024", "2024-01-02 0:00", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in frame.select(report.report_day(F.col("t"))).collect()]
    assert found == [dt.date(2024, 1, 2)] * 2 + [None] * 5


def test_summary(shop):
    found = rows(report.period_summaries(shop, {"now": JANUARY}))
    # All guests together are one customer; an order without items still counts.
    assert found == [("now", 4, 37.5, 2)]


def test_summary_of_a_period_without_orders(shop):
    empty = report.parse_period("2030-01-01", "2030-01-07")
    assert rows(report.period_summaries(shop, {"now": empty})) == [("now", 0, 0.0, 0)]


def test_summary_ignores_the_session_time_zone(shop, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    assert rows(report.period_summaries(shop, {"now": JANUARY})) == [("now", 4, 37.5, 2)]


def test_top_products_by_name(shop):
    assert rows(report.top_products(shop, JANUARY)) == [
        ("Same", 20.0), ("Product P3", 15.0), ("Product P4", 4.5)
    ]


@pytest.mark.parametrize("stored", [False, True])
def test_comparison(shop, stored):
    found = rows(report.period_comparison(shop, JANUARY, "monthly", sums(shop) if stored else None))
    assert found == [
        ("monthly", "orders", 2.0, 4.0, 100.0, "+100.00%"),
        ("monthly", "revenue", 50.0, 37.5, -25.0, "-25.00%"),
        ("monthly", "customers", 1.0, 2.0, 100.0, "+100.00%"),
    ]


def test_comparison_without_any_orders(shop):
    period = report.parse_period("2030-01-01", "2030-01-07")
    assert {r[2:] for r in rows(report.period_comparison(shop, period, "weekly"))} == {
        (0.0, 0.0, None, report.NO_PRIOR)
    }


def test_unknown_report_type(shop):
    with pytest.raises(ValueError):
        report.period_comparison(shop, JANUARY, "yearly")
