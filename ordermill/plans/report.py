"""Summary of a period against the period of the same length before it."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import amounts
from ordermill.functions.text import strip
from ordermill.plans.analytics import Sums, item_revenue_per, revenue_per
from ordermill.schemas import Tables

# Report types and the label without a prior value.
REPORT_TYPES = ["daily", "weekly", "monthly"]
NO_PRIOR = "N/A (no prior data)"


UNITS = {"daily": "day", "weekly": "week", "monthly": "month"}


class Period(NamedTuple):
    """First and last day, both included; dates or date columns."""

    start: dt.date | Column
    end: dt.date | Column


def parse_period(start: str, end: str) -> Period:
    """Two ``YYYY-MM-DD`` dates, the second not before the first."""
    days = [dt.datetime.strptime(text.strip(), "%Y-%m-%d").date() for text in (start, end)]
    if days[1] < days[0]:
        raise ValueError("the end date must not be before the start date")
    return Period(*days)


def previous_period(period: Period) -> Period:
    """The period of equal length that ends the day before, as date columns."""
    start, end = F.lit(period.start), F.lit(period.end)
    return Period(F.date_sub(start, F.date_diff(end, start) + 1), F.date_sub(start, 1))


def report_day(text: Column) -> Column:
    """A date written ``YYYY-MM-DD``, as :func:`parse_period` takes it; null for other text."""
    own = strip(text)
    return F.when(own.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), own.try_cast("date"))


def _midnight(day: dt.date | Column) -> Column:
    """A constant that reaches the scan: dates become moments without a time zone."""
    return F.lit(day).cast("timestamp_ntz")


def _within(moment: Column, period: Period) -> Column:
    after = F.date_add(F.lit(period.end), 1)
    return (moment >= _midnight(period.start)) & (moment < _midnight(after))


def _figures(
    t: Tables, s: Sums | None, span: Period, name: Column, names: DataFrame,
) -> DataFrame:
    """Orders, revenue and customers of each period of ``names``; ``name`` tells an order's period.

    Only what lies in ``span`` takes part. Orders and customers are counted on the orders alone.
    Revenue comes from the stored revenue per order, which lies in date order; else only the items
    of the span's orders are read on. A period without orders has zeros.
    """
    def inside(rows: DataFrame) -> DataFrame:
        return (
            rows.filter(_within(F.col("order_date"), span))
            .withColumn("period", name).filter("period IS NOT NULL")
        )

    orders = inside(t.orders)
    per_customer = orders.groupBy("period", "customer_id").agg(F.count("*").alias("orders"))
    counts = per_customer.groupBy("period").agg(
        F.sum("orders").alias("total_orders"), F.count("customer_id").alias("unique_customers")
    )
    if s is not None:
        sold = revenue_per(inside(s.orders), "period")
    else:
        items = t.order_items.select("order_id", "revenue")
        dated = items.join(orders.select("order_id", "period"), "order_id")
        sold = amounts.sum_per(dated, ["period"], {"revenue": F.col("revenue")})
    return names.join(counts, "period", "left").join(sold, "period", "left").select(
        "period",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce(amounts.rounded("revenue"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce("unique_customers", F.lit(0)).alias("unique_customers"),
    )


def period_summaries(
    t: Tables, periods: dict[str, Period], s: Sums | None = None
) -> DataFrame:
    """``period, total_orders, total_revenue, unique_customers`` of periods that do not overlap.

    One pass serves all periods.
    """
    name = F.coalesce(*[
        F.when(_within(F.col("order_date"), p), F.lit(name)) for name, p in periods.items()
    ])
    first, *others = periods.values()
    start, end = F.lit(first.start), F.lit(first.end)
    for other in others:
        start, end = F.least(start, F.lit(other.start)), F.greatest(end, F.lit(other.end))
    names = t.orders.sparkSession.createDataFrame([(n,) for n in periods], "period string")
    return _figures(t, s, Period(start, end), name, names)


def period_series(
    t: Tables, period: Period, report_type: str = "daily", s: Sums | None = None
) -> DataFrame:
    """The figures of each day, week (from Monday) or month of a period, empty ones included.

    The first and last week or month count the days inside the period only.
    """
    unit = _unit(report_type)
    start, end = F.lit(period.start), F.lit(period.end)

    def begin(day: Column) -> Column:
        return F.date_trunc(unit, day.cast("timestamp_ntz")).cast("date")

    step = F.make_interval(**{f"{unit}s": F.lit(1)}) if unit != "day" else F.make_dt_interval(
        days=F.lit(1))
    days = F.sequence(begin(start), end, step)
    names = t.orders.sparkSession.range(1).select(F.explode(days).alias("period"))
    found = _figures(t, s, period, begin(F.col("order_date")), names)
    after = F.date_add(F.last_day("period"), 1) if unit == "month" else F.date_add(
        "period", 7 if unit == "week" else 1)
    return found.select(
        F.lit(report_type).alias("report_type"),
        F.greatest(F.col("period"), start).alias("first_day"),
        F.least(F.date_sub(after, 1), end).alias("last_day"),
        "total_orders", "total_revenue", "unique_customers",
    ).orderBy("first_day")


def _unit(report_type: str) -> str:
    if report_type not in REPORT_TYPES:
        raise ValueError(f"report type must be one of {', '.join(REPORT_TYPES)}")
    return UNITS[report_type]


def top_products(t: Tables, period: Period, n: int = 3) -> DataFrame:
    """Product names with the highest revenue in the period."""
    orders = t.orders.filter(_within(F.col("order_date"), period)).select("order_id")
    items = t.order_items.select("order_id", "product_id", "revenue")
    sold = item_revenue_per(items.join(orders, "order_id", "left_semi"), "product_id").join(
        t.products.select("product_id", "product_name"), "product_id")
    return (
        revenue_per(sold, "product_name")
        .orderBy(F.desc(amounts.total("revenue")), "product_name")
        .limit(n)
        .select("product_name", amounts.rounded("revenue").alias("revenue"))
    )


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent; null without a prior value."""
    return F.try_divide(current - previous, previous) * 100


def change_label(change: Column) -> Column:
    return F.coalesce(F.format_string("%+.2f%%", change), F.lit(NO_PRIOR))


def period_comparison(
    t: Tables,
    period: Period,
    report_type: str = "monthly",
    s: Sums | None = None,
) -> DataFrame:
    """One row per figure: previous and current value and the change between them.

    ``report_type`` only labels the report; the dates alone set its range.
    """
    _unit(report_type)
    figures = {
        "orders": "total_orders", "revenue": "total_revenue", "customers": "unique_customers",
    }
    sides = {"previous": previous_period(period), "current": period}
    summaries = period_summaries(t, sides, s)
    both = summaries.agg(*[
        F.max(F.when(F.col("period") == side, F.col(column)))
        .cast("double").alias(f"{side}_{metric}")
        for side in sides for metric, column in figures.items()
    ])
    rows = F.array(*[
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(f"previous_{metric}").alias("previous_value"),
            F.col(f"current_{metric}").alias("current_value"),
        )
        for metric in figures
    ])
    change = percent_change(F.col("current_value"), F.col("previous_value"))
    return both.select(F.inline(rows)).select(
        F.lit(report_type).alias("report_type"),
        "metric",
        "previous_value",
        "current_value",
        F.round(change, 2).alias("percent_change"),
        F.when(F.col("previous_value") == 0, F.lit(NO_PRIOR))
        .otherwise(change_label(change)).alias("change_label"),
    )
