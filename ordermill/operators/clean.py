"""Cleaning of the raw tables. Each cleaner gives the clean rows and its issue counts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import values
from ordermill.functions.text import collapse, strip, title_case, upper_code
from ordermill.schemas import GUEST

# The metric names of the counts below, and customer ids that stand for "no customer".
MISSING_IDS = ["", "nan", "NULL", "None"]


class Cleaned(NamedTuple):
    """Clean rows, and one row of issue counts taken over the raw rows."""

    rows: DataFrame
    issues: DataFrame


def is_missing(customer_id: Column) -> Column:
    return customer_id.isNull() | strip(customer_id).isin(MISSING_IDS)


def clean_name(name: Column) -> Column:
    return title_case(collapse(strip(name)))


def clean_orders(raw: DataFrame) -> Cleaned:
    """Parse order dates, mark guest orders and tidy the codes. No order is dropped."""
    customer_id = F.col("customer_id").cast("string")
    missing = is_missing(customer_id)
    rows = raw.withColumns({
        "order_date": values.order_timestamp(F.col("order_date")),
        "customer_id": F.when(missing, GUEST).otherwise(strip(customer_id)),
        "status": upper_code(F.col("status")),
        "region_code": upper_code(F.col("region_code")),
        "is_guest_order": missing.cast("int"),
    })
    issues = raw.agg(
        F.count("*").alias("total_rows"),
        F.count_if(values.day_first_timestamp(F.col("order_date").cast("string")).isNotNull())
        .alias("wrong_date_format_fixed"),
        F.count_if(missing).alias("null_customer_id_handled"),
    )
    return Cleaned(rows, issues)


def clean_products(raw: DataFrame) -> Cleaned:
    """Product names, categories and subcategories in title case; cost as a number."""
    name = F.col("product_name")
    rows = raw.withColumns({
        "product_name": clean_name(name),
        "category": title_case(strip(F.col("category"))),
        "subcategory": title_case(strip(F.col("subcategory"))),
        "cost_price": values.to_number(F.col("cost_price")),
    })
    # Padding alone is no change; a missing name counts as one.
    changed = name.isNull() | (strip(name) != clean_name(name))
    issues = raw.agg(
        F.count("*").alias("total_rows"),
        F.count_if(changed).alias("product_names_normalized"),
    )
    return Cleaned(rows, issues)


def transaction_type(quantity: Column) -> Column:
    return (
        F.when(quantity < 0, "RETURN").when(quantity == 0, "ZERO_QTY").otherwise("PURCHASE")
    )


def clamp_percent(percent: Column) -> Column:
    return F.when(percent > 100, 100.0).when(percent < 0, 0.0).otherwise(percent)


def with_measures(items: DataFrame) -> DataFrame:
    """Adds transaction type, absolute quantity and signed revenue to typed order items."""
    return items.withColumns({
        "transaction_type": transaction_type(F.col("quantity")),
        "quantity_abs": F.abs("quantity"),
        "revenue": values.net_revenue(
            F.col("quantity"), F.col("unit_price"), F.col("discount_percent")
        ),
    })


def clean_order_items(raw: DataFrame) -> Cleaned:
    """Numbers from text, discounts within 0..100, transaction type and signed revenue.

    Numbers keep their size and precision. A quantity of any size, infinite ones too, counts by its
    sign; one that is no number counts as a purchase without revenue.
    """
    quantity = values.to_number(F.col("quantity"))
    discount = values.to_number(F.col("discount_percent"))
    rows = with_measures(raw.withColumns({
        "quantity": quantity,
        "unit_price": values.to_number(F.col("unit_price")),
        "discount_percent": clamp_percent(discount),
    }))
    issues = raw.agg(
        F.count("*").alias("total_rows"),
        F.count_if(quantity < 0).alias("negative_quantity_rows"),
        F.count_if(quantity == 0).alias("zero_quantity_rows"),
        F.count_if(discount > 100).alias("discount_over_100_capped"),
    )
    return Cleaned(rows, issues)
