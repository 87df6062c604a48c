"""Text, number and date expressions."""

import datetime as dt
import math
import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from ordermill.functions import amounts, values
from ordermill.functions.text import collapse, strip, title_case

ALPHABET = "abzABZ éÉñßσΣЖж中文 09-'.&\t\n  　\x1c_ªǆ"


def one(spark, rows, expression, kind="string"):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[1] for r in frame.select("i", expression(F.col("x"))).orderBy("i").collect()]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    return ["".join(draw.choices(ALPHABET, k=draw.randint(0, 15))) for _ in range(500)]


def test_strip_as_text_method(spark, texts):
    assert one(spark, texts, strip) == [t.strip() for t in texts]


def test_collapse(spark):
    found = one(spark, ["a \t b", "a  b", "a b", None], collapse)
    assert found == ["a b", "a b", "a b", None]


def test_title_case_as_text_method(spark, texts):
    # A single letter whose capital is two letters long stays as it is.
    plain = [t for t in texts if "ß" not in t]
    assert one(spark, plain, title_case) == [t.title() for t in plain]


def test_title_case_starts_words_after_any_mark(spark):
    found = one(spark, ["non-fiction they're 3d", "ALL CAPS", "", None], title_case)
    assert found == ["Non-Fiction They'Re 3D", "All Caps", "", None]


DATES = {
    "2024-01-05 10:11:12": ("iso", dt.datetime(2024, 1, 5, 10, 11, 12)),
    "  2024-1-5   1:2:3 ": ("iso", dt.datetime(2024, 1, 5, 1, 2, 3)),
    "05-01-2024": ("dmy", dt.datetime(2024, 1, 5)),
    "5-1-2024": ("dmy", dt.datetime(2024, 1, 5)),
    "31-12-2023\t": ("dmy", dt.datetime(2023, 12, 31)),
    "2024-01-05": ("inferred", dt.datetime(2024, 1, 5)),
    "2024-01-05T06:07:08": ("inferred", dt.datetime(2024, 1, 5, 6, 7, 8)),
    "2024/01/05": ("inferred", dt.datetime(2024, 1, 5)),
    "20240105": ("inferred", dt.datetime(2024, 1, 5)),
    "01/02/2024": ("inferred", dt.datetime(2024, 1, 2)),
    "13/02/2024": ("inferred", dt.datetime(2024, 2, 13)),
    "12-25-2024": ("inferred", dt.datetime(2024, 12, 25)),
    "01/02/2024 10:00:00": ("inferred", dt.datetime(2024, 1, 2, 10)),
    "5 Jan 2024": ("inferred", dt.datetime(2024, 1, 5)),
    "January 5, 2024": ("inferred", dt.datetime(2024, 1, 5)),
    "01/15/2024 3:30 PM": ("inferred", dt.datetime(2024, 1, 15, 15, 30)),
    "2024-01-15 12:05:09 a.m.": ("inferred", dt.datetime(2024, 1, 15, 0, 5, 9)),
    "15 January 2024 10:30": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "Jan 15 2024 03:30:01 pm": ("inferred", dt.datetime(2024, 1, 15, 15, 30, 1)),
    "15-Jan-2024": ("inferred", dt.datetime(2024, 1, 15)),
    "15-JAN-2024 23:59": ("inferred", dt.datetime(2024, 1, 15, 23, 59)),
    "Jan. 15th, 2024": ("inferred", dt.datetime(2024, 1, 15)),
    "01/02/24": ("inferred", dt.datetime(2024, 1, 2)),
    "13/02/68": ("inferred", dt.datetime(2068, 2, 13)),
    "01/02/69": ("inferred", dt.datetime(1969, 1, 2)),
    "Monday, January 15, 2024": ("inferred", dt.datetime(2024, 1, 15)),
    "Mon 15 Jan 2024": ("inferred", dt.datetime(2024, 1, 15)),
    "Jan 2024": ("inferred", dt.datetime(2024, 1, 1)),
    "20240115103000": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "20240115T1030": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "2024 Jan 15": ("inferred", dt.datetime(2024, 1, 15)),
    "15 2024 Jan": ("inferred", dt.datetime(2024, 1, 15)),
    "Sept 5 2024": ("inferred", dt.datetime(2024, 9, 5)),
    "Jan-15-2024 10:30:15 pm": ("inferred", dt.datetime(2024, 1, 15, 22, 30, 15)),
    "Jan 15 2024 10:30:15.5 PM": ("inferred", dt.datetime(2024, 1, 15, 22, 30, 15, 500_000)),
    "3:30 PM January 15 2024": ("inferred", dt.datetime(2024, 1, 15, 15, 30)),
    "13:45 2024-01-15": ("inferred", dt.datetime(2024, 1, 15, 13, 45)),
    "15/Jan/2024:10:30:00": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "15th of January 2024 at 10:30": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "1/15/24 3pm": ("inferred", dt.datetime(2024, 1, 15, 15)),
    "2024-01-15 10h30": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "Jan 15, 24": ("inferred", dt.datetime(2024, 1, 15)),
    "99-12-31": ("inferred", dt.datetime(1999, 12, 31)),
    "2024-01": ("inferred", dt.datetime(2024, 1, 1)),
    "5 2024": ("inferred", dt.datetime(2024, 5, 1)),
    "2024": ("inferred", dt.datetime(2024, 1, 1)),
    "2024.01.15": ("inferred", dt.datetime(2024, 1, 15)),
    "15.01.2024": ("inferred", dt.datetime(2024, 1, 15)),
    "2024-01-05 10:11:12.123456": ("inferred", dt.datetime(2024, 1, 5, 10, 11, 12, 123_456)),
    # Numeric zones lead to UTC; a zone's name says nothing.
    "2024-01-15 10:30:00+05:30": ("inferred", dt.datetime(2024, 1, 15, 5)),
    "2024-01-15 22:30:00 -0500": ("inferred", dt.datetime(2024, 1, 16, 3, 30)),
    "2024-01-15T10:30:00Z": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "Tue, 16 Jan 2024 10:30:00 GMT": ("inferred", dt.datetime(2024, 1, 16, 10, 30)),
    "2024-01-15 10:30 EST": ("inferred", dt.datetime(2024, 1, 15, 10, 30)),
    "10:30": ("bad", None),
    "15 Jan": ("bad", None),
    "1/2": ("bad", None),
    "5": ("bad", None),
    "Monday": ("bad", None),
    "2024-W03": ("bad", None),
    "2024-060": ("bad", None),
    "Q1 2024": ("bad", None),
    "32 Jan 2024": ("bad", None),
    "2024/13/01": ("bad", None),
    "202401": ("bad", None),
    "1705314600": ("bad", None),
    "2024-01-15 24:00:00": ("bad", None),
    "2024-01-15 10:30 11:30": ("bad", None),
    "12024-01-15 10:30:00": ("bad", None),
    "Jan Feb 5 2024": ("bad", None),
    "2024-01-15 10:30:00 (late)": ("bad", None),
    "1.5": ("bad", None),
    "15 Smarch 2024": ("bad", None),
    "01/15/2024 13:30 PM": ("bad", None),
    "31-02-2024": ("bad", None),
    "02-31-2024": ("bad", None),
    "2024-13-01 00:00:00": ("bad", None),
    "2024-01-05 25:00:00": ("bad", None),
    "soon": ("bad", None),
    "": ("bad", None),
    None: ("bad", None),
}


def test_order_dates(spark):
    texts = list(DATES)
    kinds = one(spark, texts, values.order_date_class)
    moments = one(spark, texts, values.order_timestamp)
    assert dict(zip(texts, zip(kinds, moments))) == DATES


def test_order_dates_ignore_the_session_time_zone(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    # This hour does not exist in that zone.
    assert one(spark, ["2024-03-10 02:30:00"], values.order_timestamp) == [
        dt.datetime(2024, 3, 10, 2, 30)
    ]


def test_numbers(spark):
    texts = ["5", " 5 ", "5.0", "2.5", "-3", "1e2", "x", "", "NaN", None, "1d", "2.5F ", "0x1p3",
             "1_000", "1e30", "inf", "-inf", "Infinity", "-0.0000001", "1e-400"]
    assert one(spark, texts, values.to_number) == [
        5.0, 5.0, 5.0, 2.5, -3.0, 100.0, *[None] * 8, 1e30, math.inf, -math.inf, math.inf, -1e-7, 0.0]


def revenue(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                  "i int, q double, p double, d double")
    found = frame.select("i", values.net_revenue(F.col("q"), F.col("p"), F.col("d")).alias("r"))
    return [r.r for r in found.orderBy("i").collect()]


def test_revenue_is_the_double_nearest_to_the_exact_product(spark):
    draw = random.Random(7)
    rows = []
    for _ in range(2_000):
        q = Decimal(draw.choice([draw.randint(-60, 60), draw.randint(-9, 9) * 5 + 1,
                                 3_000_000_000, 123_456_789_012]))
        q /= draw.choice([1, 1, 1, 2, 4])
        p = Decimal(draw.randint(0, 10**draw.randint(1, 10))) / 10**draw.choice([0, 2, 2, 3, 4])
        d = Decimal(draw.randint(0, 10**5)) / 10**3
        rows.append((q, p, d))
    exact = [float(q * p * (100 - d) / 100) for q, p, d in rows]
    assert revenue(spark, [tuple(map(float, r)) for r in rows]) == exact


def test_revenue_of_many_places_keeps_them(spark):
    draw = random.Random(9)
    rows = [(draw.randint(-99, 99) / 8, draw.randint(1, 10**4) / 10**6, draw.randint(0, 10**5) / 10**3)
            for _ in range(500)]
    for found, (q, p, d) in zip(revenue(spark, rows), rows, strict=True):
        assert math.isclose(found, q * p * (1 - d / 100), abs_tol=abs(q * p) * 2e-15)


def test_revenue_of_odd_numbers(spark):
    inf = math.inf
    rows = [(1e19, 3.0, 10.0), (1e17, 1e17, 0.0), (-1e-7, 2.0, 0.0), (2.0, 0.12345678, 0.0),
            (1.0, 5.0, 33.3333333), (inf, 1.0, 0.0), (inf, 1.0, 100.0), (-3.0, 5.0, 100.0),
            (None, 1.0, 0.0), (1.0, None, 0.0), (1.0, 1.0, None)]
    assert revenue(spark, rows) == [
        *[q * p * (1 - d / 100) for q, p, d in rows[:6]], None, 0.0, None, None, None]


def test_sums_do_not_depend_on_the_order(spark):
    draw = random.Random(8)
    data = [(draw.choice("ab"), draw.choice([
        draw.randint(-10**9, 10**9) / 100, draw.randint(0, 10**6) / 10**8,
        draw.randint(1, 9) * 4.5e12 + 0.55, 1e19, 0.1, None])) for _ in range(3_000)]
    with localcontext(prec=60):
        expected = {
            k: sum(Decimal(repr(x)) for g, x in data if g == k and x is not None) for k in "ab"}
    for seed in range(2):
        random.Random(seed).shuffle(data)
        frame = spark.createDataFrame(data, "k string, x double").repartition(3)
        found = amounts.sum_per(frame, ["k"], {"s": F.col("x")}).collect()
        assert {r.k: r.s for r in found} == expected
        assert all(r.s_rest is None for r in found)


def test_sums_of_odd_numbers_keep_them_all(spark):
    def total(*numbers):
        frame = spark.createDataFrame([(float(n),) for n in numbers], "x double")
        per = amounts.sum_per(frame, [], {"s": F.col("x")})
        again = amounts.sum_again(per, [], "s").select(amounts.total("s"), amounts.rounded("s"))
        return tuple(again.first())

    assert total(0.1, 0.2, 0.3) == (0.6, 0.6)
    assert total(1e-12, 1e-12) == (2e-12, 0.0)
    assert total(1e40, 5) == (1e40, 1e40)
    assert total(math.inf, 1) == (math.inf, math.inf)
    assert total(math.inf, -math.inf) == (None, None)
    assert total(1.005, 1.0) == (2.005, 2.01)
    assert total() == (None, None)


def test_not_a_number_is_null(spark):
    assert one(spark, [float("nan"), 1.5], values.to_number, "double")[0] is None


def test_days_have_one_digit(spark):
    day = values.DAY_MICROS
    found = one(spark, [day, day // 2, day // 20, day // 20 - 1, None], values.days, "bigint")
    assert found == [1.0, 0.5, 0.1, 0.0, None]


def test_percent_of_nothing_is_null(spark):
    assert one(spark, [0, 3], lambda c: values.percent_of(F.lit(1), c), "int") == [None, 33.33]
