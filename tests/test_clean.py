"""Cleaning rules on small hand-written tables."""

import datetime as dt

from ordermill.operators.clean import clean_order_items, clean_orders, clean_products
from ordermill.schemas import text_schema

ITEM = text_schema("order_items")
ORDER = text_schema("orders")


def items(spark, *rows):
    return spark.createDataFrame([("I", "O", "P", *row) for row in rows], ITEM)


def test_discount_over_100_is_capped(spark):
    cleaned = clean_order_items(items(spark, ("7", "41.5", "173")))
    row = cleaned.rows.first()
    assert row.discount_percent == 100
    assert row.revenue == 0
    assert cleaned.issues.first().discount_over_100_capped == 1


def test_zero_quantity(spark):
    cleaned = clean_order_items(items(spark, ("0", "62.25", "35")))
    row = cleaned.rows.first()
    assert (row.transaction_type, row.quantity_abs, row.revenue) == ("ZERO_QTY", 0, 0)
    assert cleaned.issues.first().zero_quantity_rows == 1


def test_future_date_is_kept(spark):
    later = dt.datetime.now().replace(microsecond=0) + dt.timedelta(days=411)
    raw = spark.createDataFrame([("O", "C", str(later), "PLACED", "NORTH")], ORDER)
    assert clean_orders(raw).rows.first().order_date == later


def test_items(spark):
    cleaned = clean_order_items(items(
        spark,
        ("-3", "10.50", "10"),      # return
        ("2", "19.99", "-5"),       # negative discount
        ("x", "10", "0"),           # no quantity: a purchase without revenue
        ("1", "bad", "0"),
        ("1", "10", "NaN"),
        ("1", "99999999999.99", "12345.5"),
        ("4.0", "0.05", "33.3"),
        ("2.5", "7", "0"),          # part of a piece
        ("-2.5", "7", "0"),
        ("3000000000", "2", "50"),
        ("1", "99.999", "12.345"),
        ("1", "8", "1e30"),
        ("1", "8", "inf"),
        ("1", "8", "-inf"),
    ))
    found = [
        (r.quantity, r.quantity_abs, r.transaction_type, r.discount_percent, r.revenue)
        for r in cleaned.rows.collect()
    ]
    assert found == [
        (-3, 3, "RETURN", 10, -28.35),
        (2, 2, "PURCHASE", 0, 39.98),
        (None, None, "PURCHASE", 0, None),
        (1, 1, "PURCHASE", 0, None),
        (1, 1, "PURCHASE", None, None),
        (1, 1, "PURCHASE", 100, 0),
        (4, 4, "PURCHASE", 33.3, 0.1334),
        (2.5, 2.5, "PURCHASE", 0, 17.5),
        (-2.5, 2.5, "RETURN", 0, -17.5),
        (3_000_000_000, 3_000_000_000, "PURCHASE", 50, 3_000_000_000),
        (1, 1, "PURCHASE", 12.345, 87.65412345),
        (1, 1, "PURCHASE", 100, 0),
        (1, 1, "PURCHASE", 100, 0),
        (1, 1, "PURCHASE", 0, 8),
    ]
    issues = cleaned.issues.first()
    assert (issues.total_rows, issues.negative_quantity_rows) == (14, 2)
    assert issues.zero_quantity_rows == 0
    assert issues.discount_over_100_capped == 3


def test_items_that_are_numbers_already(spark):
    raw = spark.createDataFrame(
        [("I", 1, 2, 3.0, 19.99, float("nan")), ("J", 1, 2, 2.5, 0.1, 120.0),
         ("K", 1, 2, -2.0, 0.1, -1.0)],
        "order_item_id string, order_id long, product_id long, quantity double, "
        "unit_price double, discount_percent double",
    )
    found = [
        (r.quantity, r.unit_price, r.discount_percent, r.revenue)
        for r in clean_order_items(raw).rows.orderBy("order_item_id").collect()
    ]
    assert found == [
        (3, 19.99, None, None),
        (2.5, 0.1, 100, 0),
        (-2, 0.1, 0, -0.2),
    ]


def test_orders_with_typed_columns(spark):
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    raw = spark.createDataFrame(
        [(1, 17, moment, "PLACED", "EAST"), (2, None, moment, "PLACED", "EAST")],
        "order_id long, customer_id long, order_date timestamp_ntz, status string, "
        "region_code string",
    )
    found = [
        (r.customer_id, r.order_date, r.is_guest_order)
        for r in clean_orders(raw).rows.orderBy("order_id").collect()
    ]
    assert found == [("17", moment, 0), ("UNKNOWN", moment, 1)]


def test_orders(spark):
    dates = ["2024-01-02 03:04:05", "02-01-2024", "2024-01-02", "31-02-2024", None, "x"]
    ids = [" C1 ", "", " NULL ", None, "nan", "NA"]
    raw = spark.createDataFrame(
        [(f"O{i}", c, d, " shipped\t", "north") for i, (c, d) in enumerate(zip(ids, dates))], ORDER
    )
    cleaned = clean_orders(raw)
    rows = cleaned.rows.orderBy("order_id").collect()
    assert [r.customer_id for r in rows] == ["C1", *["UNKNOWN"] * 4, "NA"]
    assert [r.is_guest_order for r in rows] == [0, 1, 1, 1, 1, 0]
    assert {(r.status, r.region_code) for r in rows} == {("SHIPPED", "NORTH")}
    assert cleaned.rows.columns == [*raw.columns, "is_guest_order"]
    assert cleaned.issues.first().asDict() == {
        "total_rows": 6, "wrong_date_format_fixed": 1, "null_customer_id_handled": 4,
    }


def test_products(spark):
    names = ["  Padded Name ", "UPPER NAME", "Two  Spaces", "Good Name", None]
    raw = spark.createDataFrame(
        [(f"P{i}", n, "books ", "non-fiction", "12.345" if i else "n/a")
         for i, n in enumerate(names)], text_schema("products"),
    )
    cleaned = clean_products(raw)
    rows = cleaned.rows.orderBy("product_id").collect()
    assert [r.product_name for r in rows] == [
        "Padded Name", "Upper Name", "Two Spaces", "Good Name", None
    ]
    assert {(r.category, r.subcategory) for r in rows} == {("Books", "Non-Fiction")}
    assert [r.cost_price for r in rows] == [None, *[12.345] * 4]
    # The padded name counts as unchanged.
    assert cleaned.issues.first().product_names_normalized == 3


def test_cleaning_clean_rows_changes_nothing(spark):
    raw = spark.createDataFrame([("O", "", "05-01-2024", "placed ", "east")], ORDER)
    once = clean_orders(raw).rows
    twice = clean_orders(once.drop("is_guest_order")).rows
    columns = ["order_id", "customer_id", "order_date", "status", "region_code"]
    assert once.select(columns).collect() == twice.select(columns).collect()
