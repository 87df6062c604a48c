"""Questions on small tables whose answers can be worked out by hand."""

import pytest

from ordermill.plans import analytics as a
from tests.tables import customer, item, order, product, rows, tables


@pytest.fixture(scope="module")
def shop(spark):
    return tables(
        spark,
        customers=[customer("A", "2024-01-31"), customer("B", "2024-01-01"), customer("C")],
        products=[
            product("P1", "Books", "Same"), product("P2", "Books", "Same"),
            product("P3", "Home"), product("P4", "Idle"),
        ],
        orders=[
            order("O1", "A", "2024-01-31 10:00:00", "DELIVERED"),
            order("O2", "A", "2024-03-01 22:00:00"),
            order("O3", "B", "2024-02-29 00:00:00"),
            order("O4", "UNKNOWN", "2023-02-28 23:59:59"),
            order("O5", "UNKNOWN", "2023-03-01 00:00:00", "DELIVERED"),
            order("O6", "X", "2024-02-29 00:00:00", region="SOUTH"),
            order("O7", "A", "2024-03-01 22:00:00"),
        ],
        items=[
            item("I1", "O1", "P1", 2, 10),
            item("I2", "O1", "P3", 1, 5),
            item("I3", "O2", "P2", -3, -30),
            item("I4", "O3", "P3", 0, 0),
            item("I5", "O4", "P3", 4, 7.005),
            item("I6", "O6", "P1", 1, 20),
            item("I7", "O7", "P9", 1, 100),   # unknown product
            item("I8", "O9", "P1", 1, 1),     # unknown order
        ],
    )


def test_category_revenue_leaves_out_unknown_products(shop):
    assert rows(a.revenue_by_category(shop)) == [("Home", 12.01), ("Books", 1.0)]


def test_top_customers(shop):
    # Guests and customers missing from the customer table do not take part.
    assert rows(a.top_customers(shop)) == [("A", "Name A", 85.0), ("B", "Name B", 0.0)]
    assert rows(a.top_customers(shop, n=1)) == [("A", "Name A", 85.0)]


def test_twelve_months_end_at_the_latest_order(shop):
    assert rows(a.monthly_orders(shop)) == [
        ("2023-03", 1), ("2024-01", 1), ("2024-02", 2), ("2024-03", 2)
    ]


def test_twelve_months_before_a_leap_day(spark):
    orders = [
        order("1", "A", "2024-02-29 12:00:00"),
        order("2", "A", "2023-02-28 12:00:00"),
        order("3", "A", "2023-03-01 00:00:00"),
    ]
    assert rows(a.monthly_orders(tables(spark, orders=orders))) == [("2023-03", 1), ("2024-02", 1)]


def test_never_delivered(shop):
    assert rows(a.customers_never_delivered(shop)) == [("B", "Name B", 1)]


def test_returns(shop):
    assert rows(a.returned_more_than_bought(shop)) == [("P2", "Same", 0, 3)]
    assert rows(a.return_rate_by_category(shop)) == [
        ("Books", 7, 3, 42.86), ("Home", 5, 0, 0.0)
    ]


def test_return_rate_without_pieces_is_null(spark):
    t = tables(spark, products=[product("P", "Empty")], items=[item("I", "O", "P", 0, 0)])
    assert rows(a.return_rate_by_category(t)) == [("Empty", 0, 0, None)]


def test_running_revenue(shop):
    found = [(r, str(d), x, y) for r, d, x, y in rows(a.running_revenue_by_region(shop))]
    assert found == [
        ("NORTH", "2023-02-28", 7.01, 7.01),
        ("NORTH", "2024-01-31", 15.0, 22.01),
        ("NORTH", "2024-02-29", 0.0, 22.01),
        ("NORTH", "2024-03-01", 70.0, 92.01),
        ("SOUTH", "2024-02-29", 20.0, 20.0),
    ]


def test_products_of_one_name_rank_as_one(shop):
    assert rows(a.product_rank_in_category(shop)) == [
        ("Books", "Same", 1.0, 1), ("Home", "Product P3", 12.01, 1)
    ]


def test_equal_revenues_share_a_rank(spark):
    t = tables(
        spark,
        products=[product(k, "Books") for k in "abcd"],
        items=[item(k, "O", k, 1, v) for k, v in zip("abcd", [5, 9, 9, None])],
    )
    assert [(n[-1], r) for _, n, _, r in rows(a.product_rank_in_category(t))] == [
        ("b", 1), ("c", 1), ("a", 2), ("d", 3)
    ]


def test_order_gaps(shop, many_blocks):
    found = [
        (c, str(d), p and str(p), g, risk)
        for c, d, p, g, risk in rows(a.order_gaps(shop, risk_days=15))
    ]
    # 30.5 and 0 days: 15.25 on average. A customer with one order is active.
    assert found == [
        ("A", "2024-01-31 10:00:00", None, None, "At Risk"),
        ("A", "2024-03-01 22:00:00", "2024-01-31 10:00:00", 30.5, "At Risk"),
        ("A", "2024-03-01 22:00:00", "2024-03-01 22:00:00", 0.0, "At Risk"),
        ("B", "2024-02-29 00:00:00", None, None, "Active"),
        ("X", "2024-02-29 00:00:00", None, None, "Active"),
    ]


def test_average_gap_at_the_limit_is_active(spark):
    orders = [order("1", "A", "2024-01-01 00:00:00"), order("2", "A", "2024-01-31 00:00:00")]
    assert {r[-1] for r in rows(a.order_gaps(tables(spark, orders=orders)))} == {"Active"}


@pytest.mark.parametrize("question", [a.next_order, a.next_order_by_self_join])
def test_next_order(shop, many_blocks, question):
    found = [(c, o, n, d) for c, o, _, n, _, d in rows(question(shop))]
    assert found == [
        ("A", "O1", "O2", 30.5), ("A", "O2", "O7", 0.0), ("A", "O7", None, None),
        ("B", "O3", None, None), ("X", "O6", None, None),
    ]


def test_revenue_bands(spark):
    amounts = {"A": 10_000.01, "B": 10_000, "C": 5_000, "D": 4_999.99, "E": -1, "UNKNOWN": 99_999}
    t = tables(
        spark,
        orders=[order(f"O{c}", c, "2024-05-06 07:08:09") for c in amounts],
        items=[item(f"I{c}", f"O{c}", "P", 1, v) for c, v in amounts.items()],
    )
    assert rows(a.monthly_revenue_bands(t)) == [
        ("2024-05", "High", 1), ("2024-05", "Low", 2), ("2024-05", "Medium", 2)
    ]


def test_quartiles_and_shares(spark, many_blocks):
    amounts = dict(zip("abcdef", [40, 30, 30, 20, 10, -30]))
    t = tables(
        spark,
        orders=[order(f"O{c}", c, "2024-05-06 07:08:09") for c in amounts],
        items=[item(f"I{c}", f"O{c}", "P", 1, v) for c, v in amounts.items()],
    )
    assert [(c, label) for c, _, _, label in rows(a.value_quartiles(t))] == [
        ("a", "Platinum"), ("b", "Platinum"), ("c", "Gold"), ("d", "Gold"),
        ("e", "Silver"), ("f", "Bronze"),
    ]
    # The share passes 100 % while a customer with net returns is still to come.
    assert [(c, total, share) for c, _, total, share in rows(a.cumulative_revenue_share(t))] == [
        ("a", 40.0, 40.0), ("b", 70.0, 70.0), ("c", 100.0, 100.0), ("d", 120.0, 120.0),
        ("e", 130.0, 130.0), ("f", 100.0, 100.0),
    ]


def test_share_of_nothing_is_null(spark):
    t = tables(
        spark,
        orders=[order("O", "a", "2024-05-06 07:08:09")], items=[item("I", "O", "P", 0, 0)],
    )
    assert rows(a.cumulative_revenue_share(t)) == [("a", 0.0, 0.0, None)]


def test_year_over_year(spark):
    months = {"2022-05": 50, "2023-05": 75, "2024-05": 0, "2025-05": 9, "2024-06": 1, "2027-05": 4}
    t = tables(
        spark,
        orders=[order(m, "a", f"{m}-06 07:08:09") for m in months],
        items=[item(m, m, "P", 1, v) for m, v in months.items()],
    )
    assert rows(a.revenue_year_over_year(t)) == [
        ("2022", "05", 50.0, None, None),
        ("2023", "05", 75.0, 50.0, 50.0),
        ("2024", "05", 0.0, 75.0, -100.0),
        ("2024", "06", 1.0, None, None),
        ("2025", "05", 9.0, 0.0, None),
        ("2027", "05", 4.0, None, None),   # the year before is missing
    ]


def test_orders_without_a_date(spark):
    """An unreadable date keeps its revenue, in a month or day of its own."""
    undated = order("O1", "a", "2024-05-06 07:08:09")
    t = tables(
        spark,
        orders=[(*undated[:2], None, *undated[3:]), order("O2", "a", "2024-05-06 00:00:00")],
        items=[item("I1", "O1", "P", 1, 5), item("I2", "O2", "P", 1, 7)],
    )
    assert rows(a.revenue_year_over_year(t)) == [
        (None, None, 5.0, None, None), ("2024", "05", 7.0, None, None)
    ]
    assert [(str(d), run) for _, d, _, run in rows(a.running_revenue_by_region(t))] == [
        ("None", 5.0), ("2024-05-06", 12.0)
    ]
    assert rows(a.monthly_orders(t)) == [("2024-05", 1)]
    assert [r[3] for r in rows(a.order_gaps(t))] == [None, None]
    for question in (a.next_order, a.next_order_by_self_join):
        assert [(r[1], r[3]) for r in rows(question(t))] == [("O1", "O2"), ("O2", None)]
    assert rows(a.monthly_revenue_bands(t)) == [(None, "Low", 1), ("2024-05", "Low", 1)]


def test_category_shift(shop):
    # A's last order holds only an unknown product, so the one before it counts.
    assert rows(a.category_shift(shop)) == [
        ("A", "Books", "Books", "No"), ("B", "Home", "Home", "No"), ("X", "Books", "Books", "No")
    ]


def test_category_shift_orders_items_of_one_order_by_id(spark):
    t = tables(
        spark,
        products=[product("P1", "Books"), product("P2", "Home")],
        orders=[order("O", "A", "2024-01-01 00:00:00")],
        items=[item("I2", "O", "P1", 1, 1), item("I1", "O", "P2", 1, 1)],
    )
    assert rows(a.category_shift(t)) == [("A", "Home", "Books", "Yes")]


def test_busy_customer_over_many_months(spark, many_blocks):
    """Months are blocks; what follows or precedes is found over empty months and undated orders."""
    days = [None, None, "2023-01-31", "2023-01-31", "2023-02-01", "2023-07-01", "2024-02-29"]
    orders = []
    for key in "AB":
        for i, day in enumerate(days):
            made = order(f"{key}{i}", key, f"{day or '2020-01-01'} 12:00:00")
            orders.append(made if day else (*made[:2], None, *made[3:]))
    t = tables(spark, orders=orders)
    for question in (a.next_order, a.next_order_by_self_join):
        found = {(r[1], r[3]) for r in rows(question(t))}
        assert found == {(f"{k}{i}", f"{k}{i + 1}" if i < 6 else None)
                         for k in "AB" for i in range(7)}
    gaps = [r[3] for r in rows(a.order_gaps(t)) if r[0] == "B"]
    assert gaps == [None, None, None, 0.0, 1.0, 150.0, 243.0]
    assert {r[4] for r in rows(a.order_gaps(t, risk_days=98))} == {"At Risk"}  # 394 / 4 = 98.5
    assert {r[4] for r in rows(a.order_gaps(t, risk_days=99))} == {"Active"}


def test_cohorts_count_a_double_customer_once(shop):
    twice = shop._replace(customers=shop.customers.unionAll(shop.customers))
    assert rows(a.cohort_retention(twice)) == rows(a.cohort_retention(shop))


def test_stored_sums_change_nothing(shop):
    for name, question in a.QUESTIONS.items():
        assert rows(question(shop, a.sums(shop))) == rows(question(shop)), name


def test_cohorts(shop):
    # B and C registered in the same month as A; months without activity do not appear.
    assert rows(a.cohort_retention(shop)) == [
        ("2024-01", 0, 1, 3, 33.33), ("2024-01", 1, 1, 3, 33.33), ("2024-01", 2, 1, 3, 33.33)
    ]
