"""Seeded dirty tables for any set of ids.

Every value is drawn from a hash of seed, table and row id, so a row comes out the same however
the ids are partitioned and whenever a task is run again. Ids are whole numbers from 1; use
``spark.range`` or the keys of a table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The vocabulary of the generated tables. The shares in percent, the ranges and the
# formats inside the functions below are fixed as well.
CATEGORIES = {
    "Electronics": ["Mobiles", "Laptops", "Headphones", "Cameras", "Accessories"],
    "Clothing": ["Men", "Women", "Kids", "Footwear", "Winterwear"],
    "Home": ["Kitchen", "Furniture", "Decor", "Bedding", "Storage"],
    "Books": ["Fiction", "Non-Fiction", "Comics", "Academic", "Children"],
}
REGIONS = ["NORTH", "SOUTH", "EAST", "WEST", "CENTRAL"]
CUSTOMER_TYPES = {"REGULAR": 70, "PREMIUM": 22, "VIP": 8}
ORDER_STATUSES = {"PLACED": 10, "SHIPPED": 15, "DELIVERED": 55, "CANCELLED": 12, "RETURNED": 8}
GHOST_ORDERS = 8

FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gita", "Hugo"]
LAST_NAMES = ["Abel", "Brook", "Cole", "Drake", "Ellis", "Frost", "Grant", "Hale"]
WORDS = ["Amber", "Bold", "Clear", "Deep", "Early", "Fresh", "Grand", "High"]

# Hexadecimal digits of one draw: 60 bits, so any key range fits. A hash holds two draws.
DRAW_DIGITS = 15
DRAW_SIZE = 16**DRAW_DIGITS
# Days 2021-01-01..2024-12-31 and seconds 2023-01-01..2024-12-31.
REGISTRATION_DAYS = 1461
ORDER_SECONDS = 731 * 86_400


def draw(seed: int, table: str, row_id: Column, nth: int) -> Column:
    """The row's ``nth`` random number, below ``DRAW_SIZE``."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.lit(table), F.lit(nth // 2), row_id))
    digits = F.substring(digest, 1 + nth % 2 * DRAW_DIGITS, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def below(number: Column, limit: int | Column) -> Column:
    return number % limit


def chance(number: Column, percent: float) -> Column:
    return number < DRAW_SIZE // 1000 * int(percent * 10)


def choice(number: Column, values: list[str]) -> Column:
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int")
    )


def weighted(number: Column, weights: dict[str, int]) -> Column:
    """A value with its weight in percent; the last one takes the rest."""
    spot = number % 100
    names = list(weights)
    upper = weights[names[0]]
    picked = F.when(spot < upper, names[0])
    for name in names[1:-1]:
        upper += weights[name]
        picked = picked.when(spot < upper, name)
    return picked.otherwise(names[-1])


def identifier(prefix: str, width: int, number: Column) -> Column:
    """Prefix and zero-padded number; longer numbers keep all digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), "0"))


def cents(number: Column, low: int, high: int) -> Column:
    """An amount of ``low`` to ``high`` whole units with two digits."""
    amount = low * 100 + number % ((high - low) * 100 + 1)
    return (amount.cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def tenths(number: Column, low: int, high: int) -> Column:
    amount = low * 10 + number % ((high - low) * 10 + 1)
    return (amount.cast("decimal(16,0)") * F.lit(Decimal("0.1"))).cast("decimal(6,1)")


def customers(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Customers for a column ``id``; 2 % of the emails lack the @ or the domain."""
    row = F.col("id")

    def number(nth: int) -> Column:
        return draw(seed, "customer", row, nth)

    first = choice(number(0), FIRST_NAMES)
    last = choice(F.shiftright(number(0), 3), LAST_NAMES)
    user = F.lower(F.concat(first, F.lit("."), last, row))
    registered = F.date_add(
        F.lit("2021-01-01").cast("date"), below(number(2), REGISTRATION_DAYS).cast("int")
    )
    email = (
        F.when(chance(number(1), 1), F.concat(user, F.lit("example.com")))
        .when(chance(number(1), 2), F.concat(user, F.lit("@")))
        .otherwise(F.concat(user, F.lit("@example.com")))
    )
    return ids.select(
        identifier("C", 5, row).alias("customer_id"),
        F.concat_ws(" ", first, last).alias("customer_name"),
        email.alias("email"),
        F.date_format(registered, "yyyy-MM-dd").alias("registration_date"),
        weighted(number(3), CUSTOMER_TYPES).alias("customer_type"),
    )


def products(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Products for a column ``id``; 15 % of the names are padded, upper-case or lower-case."""
    row = F.col("id")

    def number(nth: int) -> Column:
        return draw(seed, "product", row, nth)

    category = choice(number(0), list(CATEGORIES))
    subcategory = F.coalesce(*[
        F.when(category == name, choice(number(1), parts)) for name, parts in CATEGORIES.items()
    ])
    singular = F.regexp_replace(subcategory, "s$", "")
    name = F.concat_ws(
        " ", choice(number(2), WORDS), singular, choice(F.shiftright(number(2), 3), WORDS)
    )
    messy = chance(number(3), 15)
    variant = number(4) % 100
    return ids.select(
        identifier("P", 5, row).alias("product_id"),
        F.when(messy & (variant < 34), F.concat(F.lit("   "), name, F.lit("   ")))
        .when(messy & (variant < 67), F.upper(name))
        .when(messy, F.lower(name))
        .otherwise(name).alias("product_name"),
        category.alias("category"),
        subcategory.alias("subcategory"),
        cents(number(5), 50, 25_000).cast("string").alias("cost_price"),
    )


def orders(ids: DataFrame, n_customers: int | Column, seed: int = 42) -> DataFrame:
    """Orders for a column ``id``; 5 % without customer, 6 % with a DD-MM-YYYY date."""
    row = F.col("id")

    def number(nth: int) -> Column:
        return draw(seed, "order", row, nth)

    customer = identifier("C", 5, below(number(1), n_customers) + 1)
    moment = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=below(number(2), ORDER_SECONDS).cast("int")
    )
    pattern = F.when(
        chance(number(3), 6), F.date_format(moment, "dd-MM-yyyy")
    ).otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
    return ids.select(
        identifier("O", 6, row).alias("order_id"),
        F.when(chance(number(0), 5), "").otherwise(customer).alias("customer_id"),
        pattern.alias("order_date"),
        weighted(number(4), ORDER_STATUSES).alias("status"),
        choice(number(5), REGIONS).alias("region_code"),
    )


def order_items(
    ids: DataFrame, n_orders: int | Column, n_products: int | Column, seed: int = 42
) -> DataFrame:
    """Order items for a column ``id``: 1 % of a ghost order, 3 % returns, 0.5 % over 100 % off."""
    row = F.col("id")

    def number(nth: int) -> Column:
        return draw(seed, "order_item", row, nth)

    after = F.lit(n_orders) if isinstance(n_orders, int) else n_orders
    ghost = identifier("O", 6, after + 1 + below(number(1), GHOST_ORDERS))
    known = identifier("O", 6, below(number(1), n_orders) + 1)
    pieces = number(3) % 5 + 1
    return ids.select(
        identifier("OI", 6, row).alias("order_item_id"),
        F.when(chance(number(0), 1), ghost).otherwise(known).alias("order_id"),
        identifier("P", 5, below(number(2), n_products) + 1).alias("product_id"),
        F.when(chance(number(4), 3), -pieces).otherwise(pieces)
        .cast("string").alias("quantity"),
        cents(number(5), 100, 30_000).cast("string").alias("unit_price"),
        F.when(chance(number(6), 0.5), tenths(number(7), 101, 150))
        .otherwise(tenths(number(7), 0, 40))
        .cast("string").alias("discount_percent"),
    )
