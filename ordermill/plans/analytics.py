"""The sixteen business questions over clean tables.

Order items are summed per order or per product before they meet another table. That keeps hot
orders and products out of the joins: each join has one row per key on both sides. Joins carry no
broadcast hints, so Spark broadcasts a dimension only where its measured size allows it.

Guest orders share one customer id. Questions about single customers leave them out.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ordermill.functions import amounts
from ordermill.functions.values import (
    DAY_MICROS, days, fixed_moment, micros_between, month_label, percent_of,
)
from ordermill.operators import blocks
from ordermill.schemas import GUEST, Tables

QUARTILE_LABELS = ["Platinum", "Gold", "Silver", "Bronze"]


class Sums(NamedTuple):
    """What most questions need of order items: one row per order with items, and per product.

    ``orders``: order_id, customer_id, order_date, region_code, revenue. ``products``: product_id,
    revenue, pieces, bought, returned. The numbers are amounts, exact in two columns each. A run
    stores both tables once; else each question sums the columns it needs.
    """

    orders: DataFrame
    products: DataFrame


def revenue_per(rows: DataFrame, *keys) -> DataFrame:
    """Revenue per key, from rows whose revenue is summed already."""
    return amounts.sum_again(rows, list(keys), "revenue")


def item_revenue_per(items: DataFrame, key: str) -> DataFrame:
    return amounts.sum_per(items, [key], {"revenue": F.col("revenue")})


def with_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders that have items, each with the sum of its item revenues."""
    return orders.join(item_revenue_per(items, "order_id"), "order_id")


def _pieces_if(kind: str) -> Column:
    return F.when(F.col("transaction_type") == kind, F.col("quantity_abs")).otherwise(0.0)


def sums(t: Tables) -> Sums:
    orders = t.orders.select("order_id", "customer_id", "order_date", "region_code")
    return Sums(
        with_revenue(orders, t.order_items),
        amounts.sum_per(t.order_items, ["product_id"], {
            "revenue": F.col("revenue"), "pieces": F.col("quantity_abs"),
            "bought": _pieces_if("PURCHASE"), "returned": _pieces_if("RETURN"),
        }),
    )


def known_customers(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("customer_id") != GUEST)


def revenue_per_customer(s: Sums) -> DataFrame:
    """Lifetime revenue of each known customer."""
    return revenue_per(known_customers(s.orders), "customer_id")


def revenue_by_category(t: Tables, s: Sums | None = None) -> DataFrame:
    """Total revenue per product category."""
    s = s or sums(t)
    sold = s.products.select("product_id", *amounts.columns("revenue")).join(
        t.products.select("product_id", "category"), "product_id")
    return (
        revenue_per(sold, "category")
        .select("category", amounts.rounded("revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_customers(t: Tables, s: Sums | None = None, n: int = 10) -> DataFrame:
    """Customers with the highest total order value."""
    s = s or sums(t)
    return (
        revenue_per(s.orders, "customer_id")
        .join(t.customers.select("customer_id", "customer_name"), "customer_id")
        .withColumn("total_order_value", amounts.rounded("revenue"))
        .select("customer_id", "customer_name", "total_order_value")
        .orderBy(F.desc("total_order_value"), "customer_id")
        .limit(n)
    )


def monthly_orders(t: Tables, s: Sums | None = None) -> DataFrame:
    """Orders per month from twelve months before the latest order date on.

    29 February, which the year before may lack, counts as 1 March there.
    """
    last = F.max("order_date")
    first_day = F.date_add(F.add_months(F.trunc(last, "month"), -12), F.dayofmonth(last) - 1)
    start = t.orders.agg(first_day.cast("timestamp_ntz")).scalar()
    return (
        t.orders.filter(F.col("order_date") >= start)
        .groupBy(month_label(F.col("order_date")).alias("year_month"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("year_month")
    )


def customers_never_delivered(t: Tables, s: Sums | None = None) -> DataFrame:
    """Customers with orders, none of them delivered."""
    counted = t.orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("status") == "DELIVERED").alias("delivered"),
    )
    return (
        counted.filter("delivered = 0")
        .join(t.customers.select("customer_id", "customer_name"), "customer_id")
        .select("customer_id", "customer_name", "total_orders")
        .orderBy(F.desc("total_orders"), "customer_id")
    )


def returned_more_than_bought(t: Tables, s: Sums | None = None) -> DataFrame:
    """Products with more pieces returned than bought."""
    s = s or sums(t)
    return (
        s.products.select(
            "product_id", amounts.total("bought").alias("purchase_qty"),
            amounts.total("returned").alias("return_qty"),
        )
        .filter("return_qty > purchase_qty")
        .join(t.products.select("product_id", "product_name"), "product_id")
        .select("product_id", "product_name", "purchase_qty", "return_qty")
        .orderBy(F.desc("return_qty"), "product_id")
    )


def return_rate_by_category(t: Tables, s: Sums | None = None) -> DataFrame:
    """Returned pieces in percent of all pieces, per category."""
    s = s or sums(t)
    pieces = s.products.select(
        "product_id", *amounts.columns("pieces"), *amounts.columns("returned")
    ).join(t.products.select("product_id", "category"), "product_id")
    rate = percent_of(F.col("returned_items"), F.col("total_items"))
    return (
        amounts.sum_again(pieces, ["category"], "pieces", "returned")
        .select("category", amounts.total("pieces").alias("total_items"),
                amounts.total("returned").alias("returned_items"))
        .withColumn("return_rate_percent", rate)
        .orderBy(F.desc("return_rate_percent"), "category")
    )


def running_revenue_by_region(t: Tables, s: Sums | None = None) -> DataFrame:
    """Daily revenue per region and its running total.

    The window sees one row per region and calendar day, never single orders.
    """
    s = s or sums(t)
    daily = revenue_per(s.orders, "region_code", F.to_date("order_date").alias("order_date"))
    until_today = (
        Window.partitionBy("region_code").orderBy("order_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumns(amounts.over("revenue", until_today, "run")).select(
        "region_code",
        "order_date",
        amounts.rounded("revenue").alias("daily_revenue"),
        amounts.rounded("run").alias("running_total"),
    ).orderBy("region_code", "order_date")


def product_rank_in_category(t: Tables, s: Sums | None = None) -> DataFrame:
    """Product names ranked by revenue within their category; equal revenues share a rank.

    A category may hold most products, so ranks are taken in blocks.
    """
    s = s or sums(t)
    sold = s.products.select("product_id", *amounts.columns("revenue")).join(
        t.products.select("product_id", "category", "product_name"), "product_id")
    revenue = revenue_per(sold, "category", "product_name").withColumn(
        "value", amounts.total("revenue"))
    ranked = blocks.dense_rank(revenue, ["category"], "value", "product_name", "rank")
    return ranked.select(
        "category",
        "product_name",
        amounts.rounded("revenue").alias("total_revenue"),
        F.col("rank").cast("bigint").alias("rank_in_category"),
    ).orderBy("category", "rank_in_category", "product_name")


CARRIED = "__carried"
BLOCK = blocks.BLOCK


def _in_time(t: Tables) -> DataFrame:
    """Orders of known customers with their block of time, which splits busy customers.

    Blocks hold about equal numbers of all orders, whatever the times are, and orders of one instant
    are split by their ids where they are many.
    """
    orders = known_customers(t.orders).select("customer_id", "order_date", "order_id")
    since = micros_between(fixed_moment(dt.datetime(1970, 1, 1)), F.col("order_date"))
    return blocks.with_block(orders, since, "order_id", nulls_first=True).drop(blocks.BASE)


def _blocks_of(orders: DataFrame) -> DataFrame:
    """One row per customer and block: number of orders, first and last, dated ones."""
    row = F.struct("order_date", "order_id")
    return orders.groupBy("customer_id", BLOCK).agg(
        F.count("*").alias("orders"), F.min(row).alias("first"), F.max(row).alias("last"),
        F.min("order_date").alias("low"), F.max("order_date").alias("high"),
        F.count("order_date").alias("dated"),
    )


def _customer_window() -> WindowSpec:
    """A window that sees a customer's blocks, never single orders."""
    return Window.partitionBy("customer_id")


def _block_window() -> WindowSpec:
    return Window.partitionBy("customer_id", BLOCK)


def _in_blocks(orders: DataFrame, carried: DataFrame) -> DataFrame:
    """Orders and the rows carried into their blocks, placed by customer and block.

    A carried row has what a block must know of the blocks around it. The placing serves windows
    per block and the final order by customer, block and date, so orders move only once.
    """
    return (
        orders.withColumn(CARRIED, F.lit(False))
        .unionByName(carried.withColumn(CARRIED, F.lit(True)), allowMissingColumns=True)
        .repartitionByRange("customer_id", BLOCK)
    )


BLOCK_ORDER = ["customer_id", BLOCK, "order_date", "order_id"]


def order_gaps(t: Tables, s: Sums | None = None, risk_days: int = 30) -> DataFrame:
    """Days since the customer's previous order, and churn risk from the average gap.

    The gaps of a customer add up to the time between the first and the latest dated order, so the
    average needs no gap. A customer with a single order has none and counts as active.
    """
    orders = _in_time(t)
    dated = F.sum("dated").over(_customer_window())
    every = _customer_window()
    total = micros_between(F.min("low").over(every), F.max("high").over(every))
    before = F.lag("last").over(_customer_window().orderBy(BLOCK))
    carried = _blocks_of(orders).select(
        "customer_id", BLOCK,
        before["order_date"].alias("order_date"), before["order_id"].alias("order_id"),
        (total > risk_days * DAY_MICROS * (dated - 1)).alias("at_risk"),
    )
    gap = micros_between(F.col("previous_order_date"), F.col("order_date"))
    in_order = _block_window().orderBy("order_date", "order_id")
    return (
        _in_blocks(orders, carried)
        .withColumn("previous_order_date", F.lag("order_date").over(in_order))
        .withColumn("at_risk", F.max("at_risk").over(_block_window()))
        .filter(~F.col(CARRIED))
        .orderBy(*BLOCK_ORDER)
        .select(
            "customer_id",
            "order_date",
            "previous_order_date",
            days(gap).alias("days_gap"),
            F.when(F.col("at_risk"), "At Risk").otherwise("Active").alias("risk_status"),
        )
    )


def monthly_revenue_bands(
    t: Tables, s: Sums | None = None, high_above: float = 10_000, medium_from: float = 5_000
) -> DataFrame:
    """Customers per month and revenue band."""
    s = s or sums(t)
    month = month_label(F.col("order_date")).alias("year_month")
    monthly = revenue_per(known_customers(s.orders), "customer_id", month)
    value = amounts.total("revenue")
    band = (
        F.when(value > high_above, "High").when(value >= medium_from, "Medium").otherwise("Low")
    )
    # Each customer occurs once per month here, so counting rows counts customers.
    return (
        monthly.groupBy("year_month", band.alias("revenue_category"))
        .agg(F.count("customer_id").alias("customer_count"))
        .orderBy("year_month", "revenue_category")
    )


def value_quartiles(t: Tables, s: Sums | None = None) -> DataFrame:
    """Customers in four groups of equal size by lifetime value."""
    revenue = revenue_per_customer(s or sums(t)).withColumn("value", amounts.total("revenue"))
    tiled = blocks.ntile(revenue, 4, "value", "customer_id", "quartile")
    labels = F.array(*[F.lit(label) for label in QUARTILE_LABELS])
    # The rows already come in the order they were ranked by.
    return tiled.select(
        "customer_id",
        amounts.rounded("revenue").alias("total_value"),
        "quartile",
        F.element_at(labels, F.col("quartile").cast("int")).alias("quartile_label"),
    )


def revenue_year_over_year(t: Tables, s: Sums | None = None) -> DataFrame:
    """Each month's revenue next to that of the same month a year earlier."""
    s = s or sums(t)
    year, month = F.year("order_date").alias("y"), F.month("order_date").alias("m")
    monthly = revenue_per(s.orders, year, month)
    # One row per year in each window; the frame holds just the year before. Orders without a
    # date have no year and no such frame.
    year_before = Window.partitionBy("m").orderBy("y").rangeBetween(-1, -1)
    previous = {
        name: F.when(F.col("y").isNotNull(), before)
        for name, before in amounts.over("revenue", year_before, "prev_revenue").items()
    }
    now, then = amounts.total("revenue"), amounts.total("prev_revenue")
    return (
        monthly.withColumns(previous)
        .orderBy("y", "m")
        .select(
            F.lpad(F.col("y").cast("string"), 4, "0").alias("year"),
            F.lpad(F.col("m").cast("string"), 2, "0").alias("month"),
            amounts.rounded("revenue").alias("revenue"),
            amounts.rounded("prev_revenue").alias("prev_year_revenue"),
            percent_of(now - then, then).alias("yoy_growth_percent"),
        )
    )


def category_shift(t: Tables, s: Sums | None = None) -> DataFrame:
    """Category of each customer's first and latest purchase.

    First and latest item are kept per order and then per customer, both as combinable
    aggregates. Items of one order are ordered by item id. Items meet the products one by one, as
    items of unknown products do not count; hot products are found and dealt over several tasks.
    """
    item = F.struct("order_item_id", "category")
    items = t.order_items.select("order_id", "order_item_id", "product_id")
    products = t.products.select("product_id", "category")
    per_order = (
        blocks.salted_join(items, products, "product_id", spread_by="order_item_id")
        .groupBy("order_id")
        .agg(F.min(item).alias("first_item"), F.max(item).alias("last_item"))
    )
    first = F.struct("order_date", "order_id", F.col("first_item.category"))
    last = F.struct("order_date", "order_id", F.col("last_item.category"))
    shifted = F.col("first_category") != F.col("last_category")
    return (
        known_customers(t.orders).select("order_id", "customer_id", "order_date")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            F.min(first)["category"].alias("first_category"),
            F.max(last)["category"].alias("last_category"),
        )
        .withColumn("category_shift", F.when(shifted, "Yes").otherwise("No"))
        .orderBy("customer_id")
    )


def cumulative_revenue_share(t: Tables, s: Sums | None = None) -> DataFrame:
    """Running share of total revenue, from the best customer down."""
    # The rows already come in the order they were summed by.
    revenue = revenue_per_customer(s or sums(t)).withColumn("value", amounts.total("revenue"))
    running = blocks.running_total(
        revenue, amounts.columns("revenue"), "value", "customer_id",
        amounts.columns("cumulative"), amounts.columns("whole"),
    )
    return running.select(
        "customer_id",
        amounts.rounded("revenue").alias("revenue"),
        amounts.rounded("cumulative").alias("cumulative_revenue"),
        percent_of(amounts.total("cumulative"), amounts.total("whole")).alias("cumulative_percent"),
    )


def month_index(moment: Column) -> Column:
    return F.year(moment) * 12 + F.month(moment)


def cohort_retention(t: Tables, s: Sums | None = None, last_month: int = 3) -> DataFrame:
    """Share of each registration month's customers with orders in the months after."""
    registered = F.col("registration_date")
    # One row per customer and cohort, also where a load let a customer in twice.
    cohorts = t.customers.select(
        "customer_id", month_label(registered).alias("cohort_month"),
        month_index(registered).alias("start"),
    ).distinct()
    # One row per customer and month, however many orders there are.
    active = (
        known_customers(t.orders)
        .select("customer_id", month_index(F.col("order_date")).alias("month"))
        .distinct()
    )
    activity = (
        active.join(cohorts, "customer_id")
        .withColumn("month_number", F.col("month") - F.col("start"))
        .filter(F.col("month_number").between(0, last_month))
        .groupBy("cohort_month", "month_number")
        .agg(F.count("*").alias("active_customers"))
    )
    sizes = cohorts.groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    return (
        activity.join(sizes, "cohort_month")
        .select(
            "cohort_month",
            F.col("month_number").cast("bigint").alias("month_number"),
            "active_customers",
            "cohort_size",
            percent_of(F.col("active_customers"), F.col("cohort_size"))
            .alias("retention_rate_percent"),
        )
        .orderBy("cohort_month", "month_number")
    )


def _next_order_columns(rows: DataFrame) -> DataFrame:
    wait = micros_between(F.col("order_date"), F.col("next.order_date"))
    return rows.orderBy(*BLOCK_ORDER).select(
        "customer_id",
        F.col("order_id").alias("current_order_id"),
        F.col("order_date").alias("current_order_date"),
        F.col("next.order_id").alias("next_order_id"),
        F.col("next.order_date").alias("next_order_date"),
        days(wait).alias("days_until_next_order"),
    )


def next_order(t: Tables, s: Sums | None = None) -> DataFrame:
    """Each customer order with the order that follows it."""
    orders = _in_time(t)
    after = F.lead("first").over(_customer_window().orderBy(BLOCK))
    # The next block's first order stands at the end of a block.
    carried = _blocks_of(orders).select("customer_id", BLOCK, after.alias("after")).filter(
        "after IS NOT NULL").select("customer_id", BLOCK, "after.order_date", "after.order_id")
    in_order = _block_window().orderBy("order_date", "order_id")
    following = F.lead(F.struct("order_id", "order_date")).over(in_order)
    return _next_order_columns(
        _in_blocks(orders, carried).withColumn("next", following).filter(~F.col(CARRIED))
    )


def next_order_by_self_join(t: Tables, s: Sums | None = None) -> DataFrame:
    """``next_order`` by numbering the orders and joining each to the one numbered after it."""
    orders = _in_time(t)
    before = _customer_window().orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.sum("orders").over(before)
    carried = _blocks_of(orders).select(
        "customer_id", BLOCK, F.coalesce(earlier, F.lit(0)).alias("earlier")
    )
    place = F.row_number().over(
        _block_window().orderBy(F.desc(CARRIED), "order_date", "order_id"))
    numbered = (
        _in_blocks(orders, carried)
        .withColumn("n", F.max("earlier").over(_block_window()) + place - 1)
        .filter(~F.col(CARRIED)).drop("earlier", CARRIED)
    )
    following = numbered.select(
        "customer_id",
        (F.col("n") - 1).alias("n"),
        F.struct("order_id", "order_date").alias("next"),
    )
    return _next_order_columns(numbered.join(following, ["customer_id", "n"], "left"))


# Every question by its number, with its default thresholds.
QUESTIONS = {
    "q01_revenue_by_category": revenue_by_category,
    "q02_top_customers": top_customers,
    "q03_monthly_orders": monthly_orders,
    "q04_customers_never_delivered": customers_never_delivered,
    "q05_returned_more_than_bought": returned_more_than_bought,
    "q06_return_rate_by_category": return_rate_by_category,
    "q07_running_revenue_by_region": running_revenue_by_region,
    "q08_product_rank_in_category": product_rank_in_category,
    "q09_order_gaps": order_gaps,
    "q10_monthly_revenue_bands": monthly_revenue_bands,
    "q11_value_quartiles": value_quartiles,
    "q12_revenue_year_over_year": revenue_year_over_year,
    "q13_category_shift": category_shift,
    "q14_cumulative_revenue_share": cumulative_revenue_share,
    "q15_cohort_retention": cohort_retention,
    "q16_next_order": next_order,
}
