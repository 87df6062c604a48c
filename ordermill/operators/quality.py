"""Checks that report rows breaking a rule. None of them changes a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.values import fixed_moment
from ordermill.operators.clean import Cleaned
from ordermill.schemas import INPUT_PLACE, PRIMARY_KEYS

# Fixed value: a name, one @, and a domain with a dot, none of them holding blanks.
EMAIL = r"(?Ud)^[^@\s\x1c-\x1f]+@[^@\s\x1c-\x1f]+\.[^@\s\x1c-\x1f]+$"
SAMPLE_SIZE = 10


def is_valid_email(email: Column) -> Column:
    return F.coalesce(email.rlike(EMAIL), F.lit(False))


def invalid_emails(customers: DataFrame) -> DataFrame:
    """Ids of customers whose email is missing or malformed."""
    return customers.filter(~is_valid_email(F.col("email"))).select("customer_id")


def input_order(customers: DataFrame) -> str:
    """The column that orders a sample: the place in the input if it is known, else the id."""
    return INPUT_PLACE if INPUT_PLACE in customers.columns else "customer_id"


def invalid_email_sample(customers: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """The first ids with an invalid email, in input order if the rows have their places."""
    bad = customers.filter(~is_valid_email(F.col("email")))
    return bad.orderBy(input_order(customers)).limit(size).select("customer_id")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Whole child rows whose key no parent has; a row without a key is one.

    Child rows move once at most; the adaptive skew join splits a hot key.
    """
    return child.join(parent.select(key), key, "left_anti").select(child.columns)


def without_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key a parent has."""
    return child.join(parent.select(key), key, "left_semi").select(child.columns)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Each missing key with its number of child rows, counted before any row moves."""
    counted = child.groupBy(key).agg(F.count("*").alias("row_count"))
    return counted.join(parent.select(key), key, "left_anti").select(key, "row_count")


def orphan_key_audit(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Sorted distinct keys that no parent has."""
    return orphan_keys(child, parent, key).select(key).orderBy(key)


def key_violations(table: DataFrame, key: str) -> DataFrame:
    """Primary key values that occur more than once."""
    return (
        table.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("row_count"))
        .filter("row_count > 1")
    )


def future_orders(orders: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Orders dated after ``as_of`` (default: now). They stay in the table."""
    moment = F.localtimestamp() if as_of is None else fixed_moment(as_of)
    return orders.filter(F.col("order_date") > moment)


def _metrics(issues: DataFrame, table: str) -> DataFrame:
    names = issues.columns
    pairs = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("bigint").alias("value"))
        for name in names
    ])
    return issues.select(F.lit(table).alias("table_name"), F.inline(pairs)).withColumn(
        "detail", F.lit(None).cast("string")
    )


def quality_report(
    customers: DataFrame, orders: Cleaned, products: Cleaned, order_items: Cleaned,
    malformed: DataFrame | None = None,
) -> DataFrame:
    """All data quality figures, one row each: ``table_name, metric, value, detail``.

    ``detail`` holds the short sample of customer ids; the full list of orphan keys is
    ``orphan_key_audit``, as it can be of any length. ``malformed`` are the lines that the scan could
    not read whole (``table_name, line``); they are counted per table.
    """
    emails = customers.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~is_valid_email(F.col("email"))).alias("invalid_emails"),
    )
    missing = orphan_keys(order_items.rows, orders.rows, PRIMARY_KEYS["orders"]).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
        F.count("*").alias("orphan_order_ids"),
    )
    first = customers.filter(~is_valid_email(F.col("email"))).select(
        F.struct(F.col(input_order(customers)).alias("place"), "customer_id").alias("row"))
    rows = F.collect_list("row")  # of the sample alone
    sample = first.orderBy("row").limit(SAMPLE_SIZE).agg(
        F.array_join(F.transform(F.sort_array(rows), lambda r: r["customer_id"]), ", ")
        .alias("detail")
    )
    sample_row = sample.select(
        F.lit("customers").alias("table_name"),
        F.lit("invalid_email_sample").alias("metric"),
        F.lit(None).cast("bigint").alias("value"),
        "detail",
    )
    report = _metrics(orders.issues, "orders")
    for issues, table in [
        (products.issues, "products"),
        (order_items.issues, "order_items"),
        (emails, "customers"),
        (missing, "integrity"),
    ]:
        report = report.unionByName(_metrics(issues, table))
    if malformed is not None:
        report = report.unionByName(malformed.groupBy("table_name").agg(
            F.lit("malformed_lines").alias("metric"), F.count("*").alias("value"),
            F.lit(None).cast("string").alias("detail")))
    return report.unionByName(sample_row)
