"""Numbers, dates and the order revenue as column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.functions.text import BLANK, collapse, strip

DAY_MICROS = 86_400_000_000

# The two formats orders are expected in.
ISO_SECONDS = (
    rf"(?U)^{BLANK}*[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}{BLANK}+"
    rf"[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}{BLANK}*\z"
)
DAY_FIRST = rf"(?U)^{BLANK}*([0-9]{{1,2}})-([0-9]{{1,2}})-([0-9]{{4}}){BLANK}*\z"
# Month and weekday names, and words that mean nothing in a date.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]
MONTH_KEYS = [name[:3] for name in MONTHS]
MONTH_NAMES = [*MONTHS, *MONTH_KEYS, "sept"]
IDLE_WORDS = [
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "mon", "tue", "tues",
    "wed", "weds", "thu", "thur", "thurs", "fri", "sat", "sun", "at", "of", "on", "and", "ad", "t",
    "st", "nd", "rd", "th",
]
# A clock of 24 or 12 hours, also without minutes or with an h, and the zone that may end the text.
CLOCK = (
    r"(?i)(?<![\d.])\d{1,2}(?:(?::\d{1,2}){1,2}(?:[.,]\d{1,9})?(?: ?[ap]\.?m\b\.?)?"
    r"| ?[ap]\.?m\b\.?|h\d{2})(?![\d:])"
)
ZONE = rf"(?: ?(z|[+-]\d{{2}}:?\d{{2}}|(?!{'|'.join(MONTH_KEYS)})[a-z]{{3,4}})\z)?"
# Years of two digits are those from 1969 to 2068.
PIVOT = 69


# Texts that the cast takes for numbers, but that are none: letters after the digits, base 16.
NOT_A_NUMBER = r"(?i)[0-9.][df]\s*\z|0x"


def to_number(value: Column) -> Column:
    """A number of any size, infinite ones included, or null where the text is none (or NaN)."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & ~value.cast("string").rlike(NOT_A_NUMBER), number)


def day_first_timestamp(raw: Column) -> Column:
    """Midnight of a DD-MM-YYYY date; null for any other text."""
    iso = F.regexp_replace(raw, DAY_FIRST, "$3-$2-$1")
    return F.when(raw.rlike(DAY_FIRST), iso.try_cast("timestamp_ntz"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _whole(digits: Column) -> Column:
    return digits.try_cast("int")


def _is_year(digits: Column) -> Column:
    return (F.length(digits) == 4) | ((F.length(digits) == 2) & (_whole(digits) > 31))


def _date_of(numbers: Column, month: Column) -> Column:
    """Year, month and day, given the numbers in order and a month that has a name (or null).

    Three numbers are year first where the first can only be one, else month first, or day first
    where there is no such month. A missing day, or month and day, are the first.
    """
    first, second, third = (F.get(numbers, F.lit(i)) for i in range(3))
    n = F.size(numbers)
    one = F.lit("1")

    def parts(year: Column, month: Column, day: Column) -> Column:
        return F.array(year, month, day)

    named = (
        F.when((n == 1) & _is_year(first), parts(first, month, one))
        .when((n == 2) & _is_year(first), parts(first, month, second))
        .when(n == 2, parts(second, month, first))
    )
    packed = F.length(first).isin(8, 12, 14)
    plain = (
        F.when(packed & (n <= 2), parts(
            F.substring(first, 1, 4), F.substring(first, 5, 2), F.substring(first, 7, 2)))
        .when((n == 1) & (F.length(first) == 4), parts(first, one, one))
        .when((n == 2) & (F.length(first) == 4), parts(first, second, one))
        .when((n == 2) & (F.length(second) == 4), parts(second, first, one))
        .when((n == 3) & _is_year(first), parts(first, second, third))
        .when((n == 3) & (_whole(first) > 12), parts(third, second, first))
        .when(n == 3, parts(third, first, second))
    )
    return F.when(month.isNotNull(), named).otherwise(plain)


def _moment(date: Column, clock: Column, numbers: Column, zone: Column) -> Column:
    """The moment of a date's three numbers, a clock text ('' without) and a zone text."""
    year, month, day = (F.get(date, F.lit(i)) for i in range(3))
    century = F.when(_whole(year) < PIVOT, 2000).otherwise(1900)
    fits = F.length(year).isin(2, 4) & (F.length(month) <= 2) & (F.length(day) <= 2)
    # A packed clock stands behind the eight digits of a packed date, or is the second number.
    first, second = F.get(numbers, F.lit(0)), F.get(numbers, F.lit(1))
    packed = F.when(
        F.size(numbers) == 1, F.substring(first, 9, 6)
    ).when((F.length(first) == 8) & F.length(second).isin(4, 6), second).otherwise(F.lit(""))
    digits = F.when(clock != "", F.regexp_extract_all(clock, F.lit(r"\d+"), F.lit(0))).when(
        packed != "", F.regexp_extract_all(packed, F.lit(r"\d\d"), F.lit(0)))
    hour, minute, second = (
        F.coalesce(_whole(F.get(digits, F.lit(i))), F.lit(0)) for i in range(3))
    fraction = F.rpad(F.coalesce(F.get(digits, F.lit(3)), F.lit("")), 6, "0")
    half = F.lower(F.regexp_extract(clock, r"(?i)([ap])\.?m", 1))
    is_clock = F.when(half == "", hour < 24).otherwise(hour.between(1, 12)) & (minute < 60) & (
        second < 60)
    hour = F.when(half == "", hour).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    seconds = second + (_whole(fraction) * F.lit(Decimal("0.000001"))).cast("decimal(8,6)")
    moment = F.try_make_timestamp_ntz(
        _whole(year) + F.when(F.length(year) == 2, century).otherwise(0), _whole(month),
        _whole(day), hour, minute, seconds.cast("decimal(16,6)"))
    away = F.regexp_extract_all(zone, F.lit(r"\d\d"), F.lit(0))
    minutes = _whole(F.get(away, F.lit(0))) * 60 + _whole(F.get(away, F.lit(1)))
    east = F.coalesce(F.when(zone.startswith("-"), -minutes).otherwise(minutes), F.lit(0))
    return F.when(fits & is_clock, moment - F.make_dt_interval(mins=east))


def _other_timestamp(raw: Column) -> Column:
    """A date of any usual shape: clock and zone are cut out, the rest is read by its tokens.

    With a numeric zone the moment is that of UTC; names of zones but UTC say nothing.
    """
    def tokens(text: Column) -> Column:
        rest = F.regexp_replace(text, CLOCK + ZONE, " ")
        words = F.regexp_extract_all(F.lower(rest), F.lit(r"\p{L}+"), F.lit(0))
        return F.struct(
            F.regexp_extract(text, CLOCK, 0).alias("clock"),
            F.regexp_extract(text, CLOCK + ZONE, 1).alias("zone"),
            F.regexp_count(text, F.lit(CLOCK + ZONE)).alias("clocks"),
            rest.rlike(r"^[\p{L}\d\s/.,':-]*\z").alias("plain"),
            F.regexp_extract_all(rest, F.lit(r"\d+"), F.lit(0)).alias("numbers"),
            F.filter(words, lambda w: w.isin(MONTH_NAMES)).alias("months"),
            F.filter(words, lambda w: ~w.isin(MONTH_NAMES + IDLE_WORDS)).alias("others"),
        )

    def read(found: Column) -> Column:
        name = F.substring(F.get(found["months"], F.lit(0)), 1, 3)
        month = F.when(F.size(found["months"]) == 1,
                       F.array_position(F.lit(MONTH_KEYS), name).cast("string"))
        sound = (
            found["plain"] & (found["clocks"] <= 1) & (F.size(found["others"]) == 0)
            & (F.size(found["months"]) <= 1) & ~F.exists(found["numbers"], lambda n: F.length(n) > 14)
        )
        moment = _let(_date_of(found["numbers"], month), lambda date: _moment(
            date, found["clock"], found["numbers"], found["zone"]))
        return F.when(sound, moment)

    return _let(collapse(strip(raw)), lambda text: _let(tokens(text), read))


def order_timestamp(raw: Column) -> Column:
    """Parse an order date: ISO with seconds, then DD-MM-YYYY, then whatever its tokens say.

    Text that fits nothing, or names no real day, becomes null. Nearly all rows end with the first
    branch, which needs one plain regular expression.
    """
    raw = raw.cast("string")
    # Years of more digits, and zones, whose clocks the cast would keep, are left to the tokens.
    iso = F.when(raw.rlike(r"^\d{4}-\d\d?-\d\d?[\d: T.]*\z"), raw.try_cast("timestamp_ntz"))
    day_first = day_first_timestamp(raw)
    return (
        F.when(iso.isNotNull(), iso)
        .when(day_first.isNotNull(), day_first)
        .when(raw.isNotNull(), _other_timestamp(raw))
    )


def order_date_class(raw: Column) -> Column:
    """How an order date was read: ``iso``, ``dmy``, ``inferred`` or ``bad``."""
    raw = raw.cast("string")
    moment = order_timestamp(raw)
    return (
        F.when(moment.isNull(), "bad")
        .when(raw.rlike(ISO_SECONDS), "iso")
        .when(raw.rlike(DAY_FIRST) & day_first_timestamp(raw).isNotNull(), "dmy")
        .otherwise("inferred")
    )


def net_revenue(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    """Signed quantity times price less discount; a return counts negative.

    The result is the double nearest to the exact product where that has up to eleven places: whole
    pieces at prices of four and discounts of two places multiply as whole numbers, others as
    decimals. What is left, very large, very small or with more places, multiplies as doubles.
    Infinity times nothing is null.
    """
    price, percent = F.rint(unit_price * 10_000), F.rint(discount_percent * 100)
    product = quantity * price * (10_000 - percent)
    whole = (
        (F.rint(quantity) == quantity) & (price / 10_000 == unit_price)
        & (percent / 100 == discount_percent) & (F.abs(product) < 2.0**53)
        & (F.abs(quantity) < 2.0**31)  # so that no factor is rounded either
    )

    def exact(number: Column) -> Column:
        return number.try_cast("decimal(18,6)")

    numbers = (quantity, unit_price, discount_percent)
    is_exact = F.lit(True)
    for number in numbers:
        is_exact = is_exact & (exact(number).cast("double") == number)
    kept = ((F.lit(100) - exact(discount_percent)) / 100).cast("decimal(9,8)")
    decimal = F.try_multiply(F.try_multiply(exact(quantity), exact(unit_price)), kept).cast("double")
    plain = quantity * unit_price * (1 - discount_percent / 100)
    # A decimal that lost places is further away than the few roundings of doubles.
    near = is_exact & (F.abs(decimal - plain) <= F.abs(quantity * unit_price) * 1e-15)
    found = F.when(whole, product / 1e8).otherwise(F.coalesce(F.when(near, decimal), plain))
    # A discounted return of nothing is 0, not -0.
    return F.when(found == 0, F.lit(0.0)).when(~F.isnan(found), found)


def rounded(amount: Column, digits: int = 2) -> Column:
    """Rounded half away from zero, as a double for output."""
    return F.round(amount, digits).cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two digits; null for an empty whole."""
    ratio = F.try_divide(part.cast("double") * 100, whole.cast("double"))
    return F.round(ratio, 2)


def fixed_moment(moment: dt.datetime) -> Column:
    """A constant date and time, whatever the time zones of session and driver are."""
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def days(micros: Column) -> Column:
    """Fractional days with one digit."""
    return rounded(micros.cast("decimal(20,0)") / F.lit(DAY_MICROS).cast("decimal(12,0)"), 1)


def month_label(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")
