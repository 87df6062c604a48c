"""The retail tables as projections of the star-schema test tables.

``clean`` gives clean tables. ``raw`` gives the same rows in dirty text form: two date formats,
blank and NULL-like customer ids, padded and wrongly cased names and codes, discounts over 100 and
order items without an order, and dates, numbers and discounts in odd shapes. Cleaning ``raw``
must lead back to ``clean`` (less the orphans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.clean import clamp_percent, with_measures
from ordermill.schemas import GUEST, Tables
from ordermill.sources.generate import REGIONS

# Columns and types of the test tables the projections read.
STAR_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_returnflag string",
}

GHOST_OFFSET = 900_000_000_000


def _star(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return _star(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        "c_name AS customer_name",
        """concat('user', c_custkey, CASE c_custkey % 50
            WHEN 0 THEN '' WHEN 1 THEN '@' ELSE '@example.com' END) AS email""",
        "date_add(DATE '1995-01-01', CAST(c_custkey * 37 % 2000 AS INT)) AS registration_date",
        "c_mktsegment AS customer_type",
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return _star(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "initcap(p_name) AS product_name",
        "initcap(p_type) AS category",
        "p_brand AS subcategory",
        "CAST(p_retailprice AS DECIMAL(18,2)) AS cost_price",
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    regions = ", ".join(f"'{region}'" for region in REGIONS)
    return _star(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id",
        f"IF(o_orderkey % 20 = 0, '{GUEST}', CAST(o_custkey AS STRING)) AS customer_id",
        "o_orderdate AS order_date",
        """CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'SHIPPED'
            ELSE 'PLACED' END AS status""",
        f"array({regions})[CAST(o_custkey % {len(REGIONS)} AS INT)] AS region_code",
        "IF(o_orderkey % 20 = 0, 1, 0) AS is_guest_order",
    )


def _items(spark: SparkSession, folder: str) -> DataFrame:
    """Typed order items before cleaning.

    Most have whole pieces, cents and percents; some have half pieces, thousandths of a price or of
    a percent, and very many pieces.
    """
    return _star(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS order_item_id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        """CASE WHEN l_partkey % 97 = 0 THEN 0D WHEN l_partkey % 499 = 1 THEN 3000000000D
            ELSE IF(l_returnflag = 'R', -1, 1)
                * (CAST(l_quantity AS INT) + IF(l_partkey % 211 = 0, 0.5D, 0D))
            END AS quantity""",
        """(CAST(round(l_extendedprice * 100) AS BIGINT) div CAST(l_quantity AS INT) * 10
            + IF(l_partkey % 227 = 0, 9, 0)) / 1000D AS unit_price""",
        """(CAST(round(l_discount * 100) AS INT) * 1000 + IF(l_partkey % 229 = 0, 345, 0)
            + IF(l_partkey % 200 = 0, 101000, 0)) / 1000D AS discount_percent""",
    )


def clean(spark: SparkSession, folder: str) -> Tables:
    in_range = clamp_percent(F.col("discount_percent"))
    return Tables(
        customers=_customers(spark, folder),
        products=_products(spark, folder).withColumn(
            "cost_price", F.col("cost_price").cast("double")),
        orders=_orders(spark, folder),
        order_items=with_measures(
            _items(spark, folder).withColumn("discount_percent", in_range)
        ),
    )


#: Quantities, prices and discounts in text that few number types hold; null leaves the item's own.
ODD_NUMBERS = [
    ("-0.0000001", None, None), ("0.0000004", None, None), ("1e19", None, None),
    ("-1e19", None, "100.5"), ("inf", None, "0"), (" -Infinity ", None, "100"),
    (None, "0.12345678", None), (None, None, "33.3333333"), ("1e17", "1e17", None),
    ("1.5d", None, None), ("0x10", None, None), ("-0.0", None, None), ("nan", None, "-3"),
    ("123456789012", "98765.43", "12.5"), ("2", "1e-300", "-1e400"),
]


def odd_items(spark: SparkSession, folder: str) -> DataFrame:
    """Order items of which every other has one of the odd numbers, in text form."""
    rows = raw(spark, folder).order_items
    texts = [F.array(*[F.lit(odd[i]) for odd in ODD_NUMBERS]) for i in range(3)]
    at = (F.col("order_item_id") % (2 * len(ODD_NUMBERS))).cast("int")
    return rows.withColumns({
        name: F.coalesce(F.get(text, at), F.col(name)) for name, text in zip(
            ("quantity", "unit_price", "discount_percent"), texts, strict=True)
    })


def raw(spark: SparkSession, folder: str) -> Tables:
    customers = _customers(spark, folder).withColumn(
        "registration_date", F.col("registration_date").cast("string")
    )
    products = _products(spark, folder).selectExpr(
        "product_id",
        """CASE product_id % 7
            WHEN 0 THEN upper(product_name)
            WHEN 1 THEN lower(product_name)
            WHEN 2 THEN concat('  \t', product_name, '   ')
            WHEN 3 THEN replace(product_name, ' ', '  ')
            ELSE product_name END AS product_name""",
        "upper(category) AS category",
        "concat(' ', subcategory) AS subcategory",
        "IF(product_id % 100 = 0, 'n.a.', CAST(cost_price AS STRING)) AS cost_price",
    )
    orders = _orders(spark, folder).selectExpr(
        "order_id",
        """CASE WHEN order_id % 20 <> 0 THEN customer_id
            WHEN order_id % 80 = 0 THEN '' WHEN order_id % 80 = 20 THEN ' NULL '
            WHEN order_id % 80 = 40 THEN 'nan' END AS customer_id""",
        """CASE WHEN order_id % 17 = 0 THEN date_format(order_date, 'dd-MM-yyyy')
            WHEN order_id % 19 = 0 THEN date_format(order_date, CASE order_id % 13
                WHEN 6 THEN 'yyyyMMddHHmmss' WHEN 7 THEN 'yyyy MMM d'
                WHEN 8 THEN 'd/MMM/yyyy:HH:mm:ss' WHEN 9 THEN 'h:mm a MMMM d yyyy'
                WHEN 10 THEN 'MMM-dd-yyyy hh:mm:ss a' WHEN 11 THEN "yyyy-MM-dd'T'HH:mm:ss'Z'"
                WHEN 12 THEN "yyyy-MM-dd HH:mm:ss '+0000'" WHEN 0 THEN 'yyyy/MM/dd' WHEN 1 THEN 'MM/dd/yyyy h:mm a'
                WHEN 2 THEN 'd MMMM yyyy HH:mm' WHEN 3 THEN 'dd-MMM-yyyy'
                WHEN 4 THEN 'MM/dd/yy' ELSE 'EEEE, MMMM d, yyyy' END)
            WHEN order_id % 1009 = 0 THEN '31-02-2024'
            ELSE date_format(order_date, 'yyyy-MM-dd HH:mm:ss') END AS order_date""",
        "IF(order_id % 7 = 0, concat('\t', lower(status), ' '), status) AS status",
        "IF(order_id % 11 = 0, lower(region_code), region_code) AS region_code",
    )
    order_items = _items(spark, folder).selectExpr(
        "order_item_id",
        f"IF(order_id % 100 = 0, order_id + {GHOST_OFFSET}, order_id) AS order_id",
        "product_id",
        "CAST(CAST(quantity AS DECIMAL(16,6)) AS STRING) AS quantity",
        "concat(' ', CAST(unit_price AS DECIMAL(16,6))) AS unit_price",
        """CASE WHEN product_id % 400 = 0 THEN '1e30' WHEN product_id % 600 = 0 THEN 'inf'
            ELSE CAST(CAST(discount_percent AS DECIMAL(9,6)) AS STRING) END AS discount_percent""",
    )
    return Tables(customers, products, orders, order_items)
