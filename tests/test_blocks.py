"""Ordered calculations against plain windows, with ties, nulls and one large group."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators import blocks


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows belong to one group, and a third to one value."""
    draw = random.Random(3)
    data = [
        (
            draw.choice(["hot", draw.choice("abcdefgh"), draw.choice([None, "i"])]),
            draw.choice([7, draw.randint(-50, 50), draw.choice([None, 1])]),
            i,
        )
        for i in range(3_000)
    ]
    return spark.createDataFrame(data, "g string, v bigint, id bigint").cache()


def same(found, expected, columns):
    return sorted(map(str, found.select(columns).collect())) == sorted(
        map(str, expected.select(columns).collect())
    )


def order():
    return [F.desc("v"), F.asc("id")]


@pytest.mark.parametrize("nulls_first", [False, True])
def test_blocks_are_even_and_in_order(rows, nulls_first):
    order = [F.asc_nulls_first("v") if nulls_first else F.asc_nulls_last("v"), F.asc("id")]
    placed = blocks.with_block(rows, F.col("v"), "id", nulls_first, 12).collect()
    block = {r.id: r[blocks.BLOCK] for r in placed}
    in_order = [block[r.id] for r in rows.orderBy(*order).collect()]
    assert in_order == sorted(in_order)
    sizes = sorted(in_order.count(b) for b in set(in_order))
    # The hot value and the nulls are split by the tie-break column.
    assert len(sizes) >= 12
    assert sizes[-1] < 2 * len(in_order) / 12
    assert {(r.v, r[blocks.BASE]) for r in placed if r.v == 7} == {(7, placed_base(placed, 7))}


def placed_base(placed, value):
    return next(r[blocks.BASE] for r in placed if r.v == value)


@pytest.mark.parametrize("prefix", ["", "customer-with-a-long-"])
def test_texts_of_one_value_are_split_by_their_bytes(spark, prefix):
    table = spark.range(4_000).select(
        F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), 7, "0")).alias("key"),
        F.lit(5.0).alias("v"))
    placed = blocks.with_block(table, F.col("v"), "key", blocks=8).collect()
    block = [r[blocks.BLOCK] for r in sorted(placed, key=lambda r: r.key)]
    assert block == sorted(block)
    assert max(block.count(b) for b in set(block)) < 1_100


def test_infinite_values_have_blocks(spark):
    data = [(i, float(v)) for i, v in enumerate(["inf", "-inf", "0", "1", "inf", "2"])]
    table = spark.createDataFrame(data, "id int, v double")
    found = blocks.ntile(table, 3, "v", "id", "t").collect()
    assert [(r.id, r.t) for r in found] == [(0, 1), (4, 1), (5, 2), (3, 2), (2, 3), (1, 3)]


@pytest.mark.parametrize("tiles", [1, 4, 7, 2_999, 5_000])
def test_ntile(rows, many_blocks, tiles):
    found = blocks.ntile(rows, tiles, "v", "id", "t")
    expected = rows.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order())))
    assert same(found, expected, ["id", "t"])
    assert [r.id for r in found.collect()] == [r.id for r in rows.orderBy(*order()).collect()]


def test_running_total(rows, many_blocks):
    found = blocks.running_total(rows, ["v"], "v", "id", ["run"], ["all"])
    ordered = Window.orderBy(*order()).rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.withColumn("run", F.sum("v").over(ordered)).withColumn(
        "all", F.sum("v").over(Window.partitionBy())
    )
    assert same(found, expected, ["id", "run", "all"])


def test_running_total_of_nothing_is_null(spark, many_blocks):
    empty = spark.range(20).selectExpr("id", "CAST(NULL AS BIGINT) AS v")
    found = blocks.running_total(empty, ["v"], "v", "id", ["run"], ["all"]).collect()
    assert len(found) == 20
    assert {(r.run, r.all) for r in found} == {(None, None)}


def test_dense_rank(rows, many_blocks):
    found = blocks.dense_rank(rows, ["g"], "v", "id", "r")
    expected = rows.withColumn(
        "r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("v")))
    )
    assert same(found, expected, ["id", "r"])


def test_dense_rank_of_one_value(spark, many_blocks):
    equal = spark.range(500).selectExpr("id", "1 AS g", "9 AS v")
    found = blocks.dense_rank(equal, ["g"], "v", "id", "r")
    assert {r.r for r in found.collect()} == {1}


def test_empty_tables_have_no_blocks(spark):
    empty = spark.createDataFrame([], "g string, v double, id string")
    assert blocks.ntile(empty, 4, "v", "id", "t").collect() == []
    assert blocks.dense_rank(empty, ["g"], "v", "id", "r").collect() == []


def test_no_checkpoint_is_needed(spark, rows, monkeypatch):
    def refuse(*args, **kwargs):
        raise AssertionError("a checkpoint was asked for")

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", refuse)
    blocks.ntile(rows, 4, "v", "id", "t").count()
    blocks.running_total(rows, ["v"], "v", "id", ["run"], ["all"]).count()
    blocks.dense_rank(rows, ["g"], "v", "id", "r").count()


def test_salted_join(spark, many_blocks):
    many = spark.range(3_000).selectExpr("id", "IF(id % 3 = 0, 1, id % 40) AS k")
    side = spark.range(30).selectExpr("id AS k", "id * 2 AS v")
    found = blocks.salted_join(many, side, "k", spread_by="id")
    assert sorted(found.columns) == ["id", "k", "v"]
    assert same(found, many.join(side, "k"), ["id", "k", "v"])


def test_only_hot_keys_are_salted_by_their_share(spark):
    many = spark.range(9_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 9 = 1 THEN 'b' ELSE string(id) END AS k")
    assert blocks.hot_keys(many, "k", 30) == {"a": 10, "b": 4}
    assert blocks.hot_keys(spark.range(900).selectExpr("id AS k"), "k", 30) == {}
    nulls = spark.range(90).selectExpr("CAST(NULL AS BIGINT) AS k")
    assert blocks.hot_keys(nulls, "k", 30) == {}
    # The side has one row for each salt of a hot key, and one for a cold key.
    side = spark.createDataFrame([("a", 1), ("b", 2), ("1", 3), ("x", 4)], "k string, v int")
    found = blocks.salted_join(many.withColumn("id", F.monotonically_increasing_id()), side, "k", "id")
    assert found.groupBy("v").count().orderBy("v").collect() == [(1, 3000), (2, 1000)]
