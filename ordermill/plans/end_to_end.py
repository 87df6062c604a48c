"""From raw CSV files to clean tables, a quality report and all query results."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ordermill.operators.clean import Cleaned, clean_order_items, clean_orders, clean_products
from ordermill.operators.quality import quality_report, without_orphans
from ordermill.plans.analytics import QUESTIONS, Sums, sums
from ordermill.schemas import INPUT_PLACE, Tables
from ordermill.sources import files


class CleanRun(NamedTuple):
    """Clean tables and the quality report of the raw ones."""

    tables: Tables
    report: DataFrame


def clean_tables(raw: Tables, malformed: DataFrame | None = None) -> CleanRun:
    """Clean all tables. Order items without an order are left out, and counted in the report.

    Customers stay as they are: bad emails are reported, not repaired. ``malformed`` lines of the raw
    files are counted in the report, too.
    """
    orders: Cleaned = clean_orders(raw.orders)
    products: Cleaned = clean_products(raw.products)
    items: Cleaned = clean_order_items(raw.order_items)
    kept = without_orphans(items.rows, orders.rows, "order_id")
    return CleanRun(
        Tables(raw.customers.drop(INPUT_PLACE), products.rows, orders.rows, kept),
        quality_report(raw.customers, orders, products, items, malformed),
    )


def store_sums(tables: Tables, folder: str) -> Sums:
    """Revenue per order, laid out by date, and totals per product, written and read back."""
    spark = tables.orders.sparkSession
    made = sums(tables)
    by_date = made.orders.repartitionByRange("order_date", "order_id").sortWithinPartitions(
        "order_date", "order_id")
    stored = []
    for name, rows in (("order_revenue", by_date), ("product_totals", made.products)):
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        stored.append(spark.read.schema(rows.schema).parquet(f"{folder}/{name}"))
    return Sums(*stored)


def write_results(
    tables: Tables,
    folder: str,
    questions: dict[str, Callable[[Tables, Sums], DataFrame]],
    stored: Sums | None = None,
) -> None:
    """The full result of each question as CSV, ``<folder>/<question>.csv``."""
    for name, question in questions.items():
        files.write_csv(question(tables, stored), f"{folder}/{name}.csv")


def run(spark: SparkSession, raw_folder: str, out_folder: str) -> DataFrame:
    """From raw files to all results; gives the row counts of the loaded tables.

    Raw text is staged and clean tables are written, so that the CSV is parsed once and no query
    repeats the cleaning. Order items are summed per order and per product once, for all questions.
    """
    raw = files.stage_raw(files.read_raw_tables(spark, raw_folder), f"{out_folder}/staged")
    malformed = files.all_malformed_lines(spark, raw_folder)
    cleaned = clean_tables(raw, malformed)
    counts = files.load_tables(cleaned.tables, f"{out_folder}/tables")
    loaded = files.read_tables(spark, f"{out_folder}/tables")
    files.write_clean_csv(loaded, f"{out_folder}/cleaned")
    files.write_csv(cleaned.report, f"{out_folder}/data_quality_report.csv")
    stored = store_sums(loaded, f"{out_folder}/sums")
    write_results(loaded, f"{out_folder}/query_results", QUESTIONS, stored)
    return counts
