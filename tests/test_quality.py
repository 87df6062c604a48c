"""Quality checks on small tables."""

import datetime as dt

from ordermill.operators import quality

EMAILS = {
    "a@b.co": True, "a.b@c.d.e": True, "ab.co": False, "a@": False, "a@b": False, "": False,
    "a b@c.d": False, "a@@b.c": False, "a@b.c\n": True, "a@b. c": False, None: False,
}


def test_emails(spark):
    customers = spark.createDataFrame(
        [(f"C{i:02d}", e) for i, e in enumerate(EMAILS)], "customer_id string, email string"
    )
    bad = [f"C{i:02d}" for i, ok in enumerate(EMAILS.values()) if not ok]
    assert sorted(r[0] for r in quality.invalid_emails(customers).collect()) == bad
    sample = quality.invalid_email_sample(customers, 3).collect()
    assert [r[0] for r in sample] == bad[:3]


def test_item_without_order(spark):
    orders = spark.createDataFrame([("O1",), ("O2",)], "order_id string")
    items = spark.createDataFrame(
        [("I1", "O1"), ("I2", "O999"), ("I3", "O2"), ("I4", "O999"), ("I5", None)],
        "order_item_id string, order_id string",
    )
    lost = quality.orphans(items, orders, "order_id")
    kept = quality.without_orphans(items, orders, "order_id")
    assert lost.columns == items.columns
    assert sorted(r[0] for r in lost.collect()) == ["I2", "I4", "I5"]
    assert sorted(r[0] for r in kept.collect()) == ["I1", "I3"]
    keys = quality.orphan_keys(items, orders, "order_id").collect()
    assert {tuple(r) for r in keys} == {("O999", 2), (None, 1)}
    assert [r[0] for r in quality.orphan_key_audit(items, orders, "order_id").collect()] == [
        None, "O999"
    ]


def test_key_violations(spark):
    table = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,)], "k string")
    assert [tuple(r) for r in quality.key_violations(table, "k").collect()] == [("a", 2)]


def test_future_orders(spark):
    now = dt.datetime.now()
    orders = spark.createDataFrame(
        [(1, now - dt.timedelta(days=2)), (2, now + dt.timedelta(days=2)), (3, None)],
        "order_id int, order_date timestamp_ntz",
    )
    assert [r[0] for r in quality.future_orders(orders).collect()] == [2]
    early = quality.future_orders(orders, now - dt.timedelta(days=3)).collect()
    assert sorted(r[0] for r in early) == [1, 2]


def test_future_orders_ignore_the_session_time_zone(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    noon = dt.datetime(2024, 5, 6, 12)
    orders = spark.createDataFrame(
        [(1, noon), (2, noon + dt.timedelta(seconds=1))], "order_id int, order_date timestamp_ntz"
    )
    assert [r[0] for r in quality.future_orders(orders, noon).collect()] == [2]


def test_hot_orphan_key_is_split(spark, settings):
    """A third of the items name one missing order; the join splits that partition."""
    settings(
        spark__sql__shuffle__partitions="40",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    orders = spark.range(10_000).selectExpr("id AS order_id")
    items = spark.range(0, 300_000, 1, 8).selectExpr(
        "id AS order_item_id",
        "IF(id % 3 = 0, -1, id % 10000) AS order_id",
        "sha1(string(id)) AS note",
    )
    for check, expected in [(quality.orphans, 100_000), (quality.without_orphans, 200_000)]:
        rows = check(items, orders, "order_id")
        assert len(rows.collect()) == expected
        assert "skewed" in rows._jdf.queryExecution().executedPlan().toString()
