"""Every operator as a named query over the test tables, ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.values import order_date_class
from ordermill.operators import quality
from ordermill.operators.clean import clean_order_items, clean_orders, clean_products
from ordermill.plans import analytics, report
from ordermill.plans.analytics import QUESTIONS
from ordermill.plans.end_to_end import clean_tables, store_sums, write_results
from ordermill.schemas import PRIMARY_KEYS, RAW_COLUMNS, Tables
from ordermill.session import new_scratch
from ordermill.sources import files, generate, testdata

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds that split the test data; the defaults put nearly all of it on one side.
RISK_DAYS = 240
HIGH_ABOVE = 150_000
MEDIUM_FROM = 50_000
AS_OF = dt.datetime(2000, 1, 1)
PERIOD = report.parse_period("1998-01-01", "1998-01-31")
FIRST_PERIOD = report.parse_period("1995-01-01", "1995-01-31")
EMPTY_PERIOD = report.parse_period("2030-01-01", "2030-01-31")
WEEK = report.parse_period("1998-01-05", "1998-01-11")
DAY = report.parse_period("1998-01-05", "1998-01-05")
# From the middle of a week and month to a time without orders.
SERIES = report.parse_period("2001-05-17", "2001-10-10")


EARLIER = {
    "q09_order_gaps_hot_customers": "q09_order_gaps",
    "q16_next_order_hot_customers": "q16_next_order",
    "q16b_next_order_by_self_join_hot_customers": "q16b_next_order_by_self_join",
    "period_summary_many_orders": "period_summary",
    "period_top_products_many_orders": "period_top_products",
    "query_result_sink": "stored_q01_revenue_by_category",
}


def _for_output(rows: DataFrame) -> DataFrame:
    """Exact decimals as doubles."""
    return rows.select([
        F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
        for name, kind in rows.dtypes
    ])


def _on_clean(question: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: _for_output(question(testdata.clean(spark, folder)))


def _on_raw(step: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: _for_output(step(testdata.raw(spark, folder)))


def _date_classes(raw: Tables) -> DataFrame:
    kind = order_date_class(F.col("order_date")).alias("date_class")
    return raw.orders.groupBy(kind).agg(F.count("*").alias("order_count"))


def _orphan_check(check: Callable[[DataFrame, DataFrame, str], DataFrame]) -> Query:
    return _on_raw(lambda raw: check(
        clean_order_items(raw.order_items).rows, clean_orders(raw.orders).rows, "order_id"
    ))


def _orphan_count(items: DataFrame, orders: DataFrame, key: str) -> DataFrame:
    return quality.orphan_keys(items, orders, key).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
        F.count("*").alias("orphan_keys"),
    )


def _duplicate_keys(clean: Tables) -> DataFrame:
    checks = [
        quality.key_violations(rows, PRIMARY_KEYS[name]).select(
            F.lit(name).alias("table_name"),
            F.col(PRIMARY_KEYS[name]).cast("string").alias("key_value"),
            "row_count",
        )
        for name, rows in clean._asdict().items()
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2]).unionByName(checks[3])


CLEANERS = {
    "customers": lambda rows: rows,
    "products": lambda rows: clean_products(rows).rows,
    "orders": lambda rows: clean_orders(rows).rows,
    "order_items": lambda rows: clean_order_items(rows).rows,
}


def _csv_scan(table: str) -> Query:
    """A raw table written to CSV, scanned as text and cleaned."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = new_scratch(spark, "raw")
        rows = getattr(testdata.raw(spark, folder), table)
        files.write_csv(rows, f"{path}/{table}.csv")
        return _for_output(CLEANERS[table](files.read_raw(spark, path, table)))

    return query


def _csv_reload(table: str) -> Query:
    """A clean table written to CSV and read back in its types."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = new_scratch(spark, "cleaned")
        files.write_csv(getattr(testdata.clean(spark, folder), table), f"{path}/{table}.csv")
        return _for_output(files.read_clean_csv(spark, path, table))

    return query


def _load(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned raw tables loaded as typed tables; the test order items have no unique key."""
    cleaned = clean_tables(testdata.raw(spark, folder)).tables
    return files.load_tables(cleaned, new_scratch(spark, "tables"), unique_keys=False)


def _stored_result(name: str) -> Query:
    """A question's result from stored sums, saved under its name and read back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = new_scratch(spark, "results")
        t = testdata.clean(spark, folder)
        made = []

        def question(t: Tables, s: analytics.Sums) -> DataFrame:
            made.append(_for_output(QUESTIONS[name](t, s)))
            return made[0]

        write_results(t, path, {name: question}, store_sums(t, f"{path}/sums"))
        return spark.read.schema(made[0].schema).options(**files.CSV_OPTIONS).csv(
            f"{path}/{name}.csv")

    return query


def _period_from_sums(spark: SparkSession, folder: str) -> DataFrame:
    t = testdata.clean(spark, folder)
    stored = store_sums(t, new_scratch(spark, "sums"))
    return report.period_comparison(t, PERIOD, s=stored)


def _periods_before(t: Tables) -> DataFrame:
    """Each month with orders as a period, and the period before it."""
    first = F.trunc("order_date", "month").alias("start")
    months = t.orders.select(first).distinct().withColumn("end", F.last_day("start"))
    before = report.previous_period(report.Period(F.col("start"), F.col("end")))
    return months.select("start", "end", before.start.alias("previous_start"),
                         before.end.alias("previous_end"))


def _period_of_all_orders(t: Tables) -> DataFrame:
    """The summary of the period from the first to the latest order, given as the report's texts."""
    first, last = t.orders.agg(
        *[F.date_format(f("order_date"), "yyyy-MM-dd") for f in (F.min, F.max)]).first()
    return report.period_summaries(t, {"all": report.parse_period(first, last)})


def _series(report_type: str, stored: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        t = testdata.clean(spark, folder)
        s = store_sums(t, new_scratch(spark, "sums")) if stored else None
        return report.period_series(t, SERIES, report_type, s)

    return query


def _report_days(raw: Tables) -> DataFrame:
    """How many registration and order dates are written as the report wants its dates."""
    texts = raw.customers.select(F.col("registration_date").alias("day")).unionAll(
        raw.orders.select("order_date"))
    valid = report.report_day(F.col("day")).isNotNull().alias("valid")
    return texts.groupBy(valid).agg(F.count("*").alias("days"))


def _csv_email_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The sample of a raw table of several files, which hold the customers by registration."""
    path = new_scratch(spark, "raw")
    customers = testdata.raw(spark, folder).customers
    files.write_csv(customers.orderBy(F.desc("registration_date"), "customer_id"),
                    f"{path}/customers.csv")
    rows = files.read_raw(spark, path, "customers", with_place=True)
    return quality.invalid_email_sample(rows)


def _malformed(spark: SparkSession, folder: str) -> str:
    """Raw tables of which some order lines lack their last field or have one too many."""
    path = new_scratch(spark, "raw")
    raw = testdata.raw(spark, folder)
    for name, rows in raw._asdict().items():
        if name == "orders":
            # Without quotes a comma in the last column makes fields.
            last = F.expr("""CASE WHEN order_id % 23 = 0 THEN 'PLACED'
                WHEN order_id % 29 = 0 THEN 'PLACED,EAST,more' ELSE 'PLACED,EAST' END""")
            header = ",".join(RAW_COLUMNS["orders"])
            lines = rows.select(F.concat_ws(
                ",", "order_id", F.lit("C1"), F.lit("2024-01-05 10:11:12"), last).alias(header))
            # Lines are single fields without quotes; each part file has the header.
            lines.write.options(**{**files.CSV_OPTIONS, "sep": "\u0001"}).csv(f"{path}/orders.csv")
        else:
            files.write_csv(rows, f"{path}/{name}.csv")
    return path


def _malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return files.all_malformed_lines(spark, _malformed(spark, folder))


def _malformed_report(spark: SparkSession, folder: str) -> DataFrame:
    """The order rows of the quality report over such files."""
    path = _malformed(spark, folder)
    raw = files.read_raw_tables(spark, path)
    report_rows = clean_tables(raw, files.all_malformed_lines(spark, path)).report
    return report_rows.filter("table_name = 'orders'").drop("detail")


def _bucketed(question: Callable[[Tables], DataFrame]) -> Query:
    """A question over catalog tables bucketed by order."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        # A database of its own, so that two runs at once do not share tables.
        name = f"ordermill_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name}")
        t = testdata.clean(spark, folder)
        return _for_output(question(files.save_bucketed(t, name, 8)))

    return query


def _stored_report(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch(spark, "report")
    files.write_csv(clean_tables(testdata.raw(spark, folder)).report, path)
    schema = "table_name string, metric string, value bigint, detail string"
    return spark.read.schema(schema).options(**files.CSV_OPTIONS).csv(path)


def _generated(table: str) -> Query:
    """A generated table with one row per row of the test table."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        t = testdata.clean(spark, folder)

        def ids(rows: DataFrame, key: str) -> DataFrame:
            return rows.select((F.col(key).cast("bigint") + 1).alias("id"))

        def size(rows: DataFrame):
            return rows.agg(F.count("*")).scalar()

        if table == "customers":
            return generate.customers(ids(t.customers, "customer_id"))
        if table == "products":
            return generate.products(ids(t.products, "product_id"))
        if table == "orders":
            return generate.orders(ids(t.orders, "order_id"), size(t.customers))
        return generate.order_items(
            ids(t.order_items, "order_item_id"), size(t.orders), size(t.products)
        )

    return query


def _after_cleaning(question: Callable[[Tables], DataFrame]) -> Query:
    """A question over tables that were cleaned from raw text and loaded."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = new_scratch(spark, "tables")
        cleaned = clean_tables(testdata.raw(spark, folder)).tables
        files.load_tables(cleaned, path, unique_keys=False)
        return _for_output(question(files.read_tables(spark, path)))

    return query


def queries() -> dict[str, Query]:
    scaled = {
        "q09_order_gaps": partial(analytics.order_gaps, risk_days=RISK_DAYS),
        "q10_monthly_revenue_bands": partial(
            analytics.monthly_revenue_bands, high_above=HIGH_ABOVE, medium_from=MEDIUM_FROM
        ),
    }
    found = {name: _on_clean(scaled.get(name, ask)) for name, ask in QUESTIONS.items()}
    found |= {
        "q09_order_gaps_default": _on_clean(analytics.order_gaps),
        "q10_monthly_revenue_bands_default": _on_clean(analytics.monthly_revenue_bands),
        "q15_cohort_retention_double_customers": _on_clean(
            lambda t: analytics.cohort_retention(
                t._replace(customers=t.customers.unionAll(t.customers)))
        ),
        "q16b_next_order_by_self_join": _on_clean(analytics.next_order_by_self_join),
        "clean_orders": _on_raw(lambda raw: clean_orders(raw.orders).rows),
        "clean_products": _on_raw(lambda raw: clean_products(raw.products).rows),
        "clean_order_items": _on_raw(lambda raw: clean_order_items(raw.order_items).rows),
        "clean_orders_issues": _on_raw(lambda raw: clean_orders(raw.orders).issues),
        "clean_products_issues": _on_raw(lambda raw: clean_products(raw.products).issues),
        "clean_order_items_issues": _on_raw(
            lambda raw: clean_order_items(raw.order_items).issues
        ),
        "odd_numbers": lambda spark, folder: clean_order_items(
            testdata.odd_items(spark, folder)).rows,
        "odd_numbers_issues": lambda spark, folder: clean_order_items(
            testdata.odd_items(spark, folder)).issues,
        "order_date_classes": _on_raw(_date_classes),
        "invalid_emails": _on_raw(lambda raw: quality.invalid_emails(raw.customers)),
        "invalid_email_sample": _on_raw(lambda raw: quality.invalid_email_sample(raw.customers)),
        "orphan_items": _orphan_check(quality.orphans),
        "items_without_orphans": _orphan_check(quality.without_orphans),
        "orphan_order_ids": _orphan_check(quality.orphan_key_audit),
        "orphan_count": _orphan_check(_orphan_count),
        "orders_without_customer": _on_clean(
            lambda t: quality.orphans(t.orders, t.customers, "customer_id")
        ),
        "key_violations": _on_clean(_duplicate_keys),
        "future_orders": _on_clean(lambda t: quality.future_orders(t.orders, AS_OF)),
        "quality_report": _on_raw(lambda raw: clean_tables(raw).report),
        "period_summary": _on_clean(
            lambda t: report.period_summaries(t, {"current": PERIOD})
        ),
        "period_top_products": _on_clean(lambda t: report.top_products(t, PERIOD)),
        "period_comparison": _on_clean(lambda t: report.period_comparison(t, PERIOD)),
        "period_summary_empty": _on_clean(
            lambda t: report.period_summaries(t, {"current": EMPTY_PERIOD})
        ),
        "period_comparison_no_prior": _on_clean(
            lambda t: report.period_comparison(t, FIRST_PERIOD)
        ),
        "period_comparison_weekly": _on_clean(
            lambda t: report.period_comparison(t, WEEK, "weekly")
        ),
        "period_comparison_daily": _on_clean(lambda t: report.period_comparison(t, DAY, "daily")),
        "period_comparison_from_sums": _period_from_sums,
        "periods_before": _on_clean(_periods_before),
        "period_of_all_orders": _on_clean(_period_of_all_orders),
        "period_series_daily": _series("daily"),
        "period_series_weekly": _series("weekly"),
        "period_series_monthly": _series("monthly", stored=True),
        "report_days": _on_raw(_report_days),
        "table_load_counts": _load,
        "bucketed_running_revenue": _bucketed(analytics.running_revenue_by_region),
        "quality_report_sink": _stored_report,
        "csv_invalid_email_sample": _csv_email_sample,
        "csv_malformed_lines": _malformed_lines,
        "quality_report_malformed_lines": _malformed_report,
        "cleaned_revenue_by_category": _after_cleaning(analytics.revenue_by_category),
        "cleaned_value_quartiles": _after_cleaning(analytics.value_quartiles),
    }
    for table in Tables._fields:
        found[f"generated_{table}"] = _generated(table)
        found[f"csv_scan_{table}"] = _csv_scan(table)
        found[f"csv_reload_{table}"] = _csv_reload(table)
    for name in QUESTIONS:
        found[f"stored_{name}"] = _stored_result(name)
    # Names of earlier entries, whose cases the plain queries cover at every size.
    found |= {earlier: found[name] for earlier, name in EARLIER.items()}
    return found
