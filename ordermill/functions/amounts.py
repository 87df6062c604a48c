"""Sums of doubles that are exact where decimals are, whatever the order of the rows is.

Quantities, prices and revenues are doubles, so numbers of any size and precision stay as they are.
A sum has two parts: column ``x`` adds up, as a decimal, all doubles that stand for a decimal with
up to eight places; ``x_rest`` adds up the others as doubles and is null where there is none. Only
the second part can depend on the order of the rows, and it has the odd numbers only.

The first level of sums reads doubles (:func:`sum_per`), further levels add up the two parts
(:func:`sum_again`, :func:`over`). :func:`total` makes one double of both, for order and output.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

PLACES = 8
#: One digit less than there can be, so that a sum of two keeps all places.
EXACT = f"decimal(37,{PLACES})"
REST = "_rest"

_UNIT = 10.0**PLACES
#: Below this, a double times the unit is a whole number that doubles hold exactly.
_SMALL = 2.0**53 / _UNIT


def _units(value: Column) -> Column:
    return F.rint(value * _UNIT)


def _is_short(value: Column) -> Column:
    """Whether a double is the nearest one to a not too large decimal of few places."""
    return (F.abs(value) < _SMALL) & (_units(value) / _UNIT == value)


def _wide(value: Column) -> Column:
    """Other doubles as decimals, if their shortest text is one of few places; else null."""
    exact = value.try_cast(EXACT)
    return F.when(exact.cast("double") == value, exact)


#: A number of units is added up in parts of so many bits, which no number of rows overflows.
_BITS = 18


def _parts(name: str, value: Column) -> dict[str, Column]:
    """Three parts of a short decimal's units, a wide decimal, and what is left."""
    short = _is_short(value)
    units = F.when(short, _units(value).cast("bigint"))
    wide = F.when(~short, _wide(value))
    low = F.lit((1 << _BITS) - 1)
    return {
        f"{name}_0": units.bitwiseAND(low),
        f"{name}_1": F.shiftright(units, _BITS).bitwiseAND(low),
        f"{name}_2": F.shiftright(units, 2 * _BITS),
        f"{name}_3": wide,
        f"{name}_4": F.when(~short & wide.isNull(), value),
    }


def _sums(name: str) -> list[Column]:
    """Few rows have the last two parts; a filter spares the others the wide additions."""
    rare = [F.expr(f"sum(`{p}`) FILTER (WHERE `{p}` IS NOT NULL)").alias(p)
            for p in (f"{name}_3", f"{name}_4")]
    return [F.sum(f"{name}_{i}").alias(f"{name}_{i}") for i in range(3)] + rare


def columns(name: str) -> list[str]:
    """The names of both parts of a sum."""
    return [name, name + REST]


def sum_per(rows: DataFrame, keys: list, measures: dict[str, Column]) -> DataFrame:
    """The sums of double ``measures`` per key, each in its two parts."""
    parted = rows.withColumns({
        part: column for n, value in measures.items() for part, column in _parts(n, value).items()
    })
    summed = parted.groupBy(*keys).agg(*[c for n in measures for c in _sums(n)])
    unit = F.lit(Decimal(1).scaleb(-PLACES))
    out = []
    for n in measures:
        units = F.lit(0).cast("decimal(38,0)")
        for i in range(3):
            part = F.col(f"{n}_{i}").cast("decimal(19,0)")
            units = (units + part * F.lit(Decimal(1 << (i * _BITS)))).cast("decimal(29,0)")
        short = (units * unit).cast(EXACT)
        both = F.coalesce(short, F.lit(0).cast(EXACT)) + F.col(f"{n}_3").cast(EXACT)
        out += [F.coalesce(both, short).alias(n), F.col(f"{n}_4").alias(n + REST)]
    return summed.select(*summed.columns[:len(keys)], *out)


def sum_again(rows: DataFrame, keys: list, *names: str) -> DataFrame:
    """The sums per key of amounts that have two parts each."""
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for n in names for c in columns(n)])


def over(name: str, window: WindowSpec, to: str) -> dict[str, Column]:
    """The sums of an amount over a window, as both parts of a new one."""
    return {new: F.sum(old).over(window)
            for old, new in zip(columns(name), columns(to), strict=True)}


def total(name: str) -> Column:
    """An amount as one double; null where nothing was summed, or infinities cancel out."""
    exact, rest = F.col(name).cast("double"), F.col(name + REST)
    both = F.coalesce(exact, F.lit(0.0)) + rest
    return F.when(rest.isNull(), exact).when(~F.isnan(both), both)


def rounded(name: str, digits: int = 2) -> Column:
    """An amount rounded half away from zero, as a double for output."""
    return F.when(F.col(name + REST).isNull(), F.round(F.col(name), digits).cast("double")).otherwise(
        F.round(total(name), digits))
