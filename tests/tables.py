"""Small clean tables written by hand."""

import datetime as dt

from ordermill.schemas import CLEAN_TYPES, Tables


def _frame(spark, table, rows):
    ddl = ", ".join(f"{name} {kind}" for name, kind in CLEAN_TYPES[table].items())
    return spark.createDataFrame(rows, ddl)


def customer(key, registered="2024-01-01"):
    return (key, f"Name {key}", f"{key}@x.org", dt.date.fromisoformat(registered), "VIP")


def product(key, category, name=None):
    return (key, name or f"Product {key}", category, "Sub", 1.0)


def order(key, customer_id, moment, status="PLACED", region="NORTH"):
    guest = int(customer_id == "UNKNOWN")
    return (key, customer_id, dt.datetime.fromisoformat(moment), status, region, guest)


def item(key, order_id, product_id, quantity, revenue):
    kind = "RETURN" if quantity < 0 else "PURCHASE" if quantity else "ZERO_QTY"
    pieces = float(quantity)
    return (key, order_id, product_id, pieces, 1.0, 0.0, kind, abs(pieces),
            None if revenue is None else float(revenue))


def tables(spark, customers=(), products=(), orders=(), items=()):
    return Tables(
        _frame(spark, "customers", list(customers)),
        _frame(spark, "products", list(products)),
        _frame(spark, "orders", list(orders)),
        _frame(spark, "order_items", list(items)),
    )


def rows(frame):
    return [tuple(r) for r in frame.collect()]
