"""The four retail tables: columns, types and keys."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

# Names of tables, columns and the guest customer.
GUEST = "UNKNOWN"

CUSTOMERS = "customers"
PRODUCTS = "products"
ORDERS = "orders"
ORDER_ITEMS = "order_items"

PRIMARY_KEYS = {
    CUSTOMERS: "customer_id",
    PRODUCTS: "product_id",
    ORDERS: "order_id",
    ORDER_ITEMS: "order_item_id",
}

# The column that holds a row's place in its input files.
INPUT_PLACE = "input_place"

# Numbers of any size and precision; functions/amounts.py adds them up exactly.
NUMBER = "double"

RAW_COLUMNS = {
    CUSTOMERS: ["customer_id", "customer_name", "email", "registration_date", "customer_type"],
    PRODUCTS: ["product_id", "product_name", "category", "subcategory", "cost_price"],
    ORDERS: ["order_id", "customer_id", "order_date", "status", "region_code"],
    ORDER_ITEMS: [
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent",
    ],
}

CLEAN_TYPES = {
    CUSTOMERS: {
        "customer_id": "string",
        "customer_name": "string",
        "email": "string",
        "registration_date": "date",
        "customer_type": "string",
    },
    PRODUCTS: {
        "product_id": "string",
        "product_name": "string",
        "category": "string",
        "subcategory": "string",
        "cost_price": NUMBER,
    },
    ORDERS: {
        "order_id": "string",
        "customer_id": "string",
        "order_date": "timestamp_ntz",
        "status": "string",
        "region_code": "string",
        "is_guest_order": "int",
    },
    ORDER_ITEMS: {
        "order_item_id": "string",
        "order_id": "string",
        "product_id": "string",
        "quantity": NUMBER,
        "unit_price": NUMBER,
        "discount_percent": NUMBER,
        "transaction_type": "string",
        "quantity_abs": NUMBER,
        "revenue": NUMBER,
    },
}


def text_schema(table: str) -> str:
    """DDL of a raw table: every field is text until it is cleaned."""
    return ", ".join(f"{name} string" for name in RAW_COLUMNS[table])


class Tables(NamedTuple):
    """The four tables a step or query works on."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
