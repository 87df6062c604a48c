"""Ordered calculations over groups of any size.

A window puts each of its groups into one task, so a ranking over all rows, or over a group
with a third of them, does not scale. Here every row belongs to a *block*, a run of neighbouring
values of bounded size, whatever the group sizes are. Windows run per block; what a block must know
about the blocks before it comes from a summary of a few values per block and group.

The edges of the blocks are quantiles of the values, from a sketch that Spark merges over all tasks:
one aggregation, of which a few numbers per block reach the driver. A block follows from a row's own
value, so every pass and every retry sees the same blocks. A value that alone fills a block or more
is a block of its own, and its rows are split by the tie-break column, by quantiles of it.
"""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "__block"
BASE = "__base"
PLACE = "__place"
GROUP = "__group"
#: Blocks for each partition of a shuffle, so that partitions come out even.
BLOCKS_PER_PARTITION = 3
#: Bytes of a text that one double can hold in order.
KEY_BYTES = 6
#: How many such keys are tried, for texts that all begin alike.
KEYS = 6
#: How many hot keys are looked for at most, and how many keys the sketch tracks for each.
MOST_HOT_KEYS = 1_000
TRACKED_PER_KEY = 20


class Edges(NamedTuple):
    """Values that divide the rows, and tie-break keys that divide the rows of one value."""

    points: list[float]
    hot: list[bool]
    hot_nulls: bool
    ties: list[float]
    tie_key: int


def _number(column: Column) -> Column:
    return column.cast("double")


def _tie_keys(rows: DataFrame, tie: str) -> list[Column]:
    """Numbers in the order of the tie-break column; later ones serve where earlier ones are equal."""
    if not isinstance(rows.schema[tie].dataType, T.StringType):
        return [_number(F.col(tie))]
    data = F.encode(F.col(tie), "UTF-8")
    digits = 2 * KEY_BYTES
    return [
        F.conv(F.rpad(F.hex(F.substring(data, 1 + i * KEY_BYTES, KEY_BYTES)), digits, "0"), 16, 10)
        .cast("double") for i in range(KEYS)
    ]


def edges(rows: DataFrame, value: Column, tie: str, blocks: int) -> Edges:
    """The edges of about ``blocks`` blocks of equal size, by one aggregation."""
    ranks = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
    keys = _tie_keys(rows, tie)
    names = [f"key{i}" for i in range(len(keys))]
    table = rows.select(_number(value).alias("value"), *[
        k.alias(n) for k, n in zip(keys, names, strict=True)])

    def quantiles(name: str) -> Column:
        sketch = F.kll_sketch_agg_double(name)
        some = F.count(name) > 0
        return F.when(some, F.kll_sketch_get_quantile_double(sketch, ranks)).alias(name)

    found = table.agg(
        F.count("*").alias("rows"), F.count("value").alias("known"), quantiles("value"),
        *[c for n in names for c in (
            quantiles(n), (F.min(n) < F.max(n)).alias(f"{n}_differs"))],
    ).first()
    values = found.value or []
    finite = sorted({v for v in values if abs(v) != float("inf")})
    chosen = next((i for i, n in enumerate(names) if found[f"{n}_differs"]), 0)
    return Edges(
        points=finite,
        hot=[values.count(v) > 1 for v in finite],
        hot_nulls=(found.rows - found.known) * blocks > found.rows,
        ties=sorted(set(found[names[chosen]] or [])),
        tie_key=chosen,
    )


def _bucket(rows: DataFrame, column: str, points: list[float], to: str) -> DataFrame:
    """Adds the number of points up to a column's value."""
    if not points:
        return rows.withColumn(to, F.lit(0.0))
    return Bucketizer(splits=[float("-inf"), *points, float("inf")], inputCol=column, outputCol=to,
                      handleInvalid="keep").transform(rows)


def with_block(
    rows: DataFrame, value: Column, tie: str, nulls_first: bool = False, blocks: int | None = None,
) -> DataFrame:
    """Adds ``BLOCK``, which ascends with ``value`` and, within equal values, with ``tie``.

    ``BASE`` is the same for all blocks of one value. Building this runs one aggregation.
    """
    if blocks is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = BLOCKS_PER_PARTITION * partitions
    found = edges(rows, value, tie, max(blocks, 2))
    key = _tie_keys(rows, tie)[found.tie_key]
    columns = rows.columns
    placed = rows.withColumns({"__value": _number(value), "__key": key})
    placed = _bucket(placed, "__value", found.points, "__at")
    placed = _bucket(placed, "__key", found.ties, "__tie")
    at = F.col("__at").cast("int")
    # Below the first point, on a point, between points: 0, 1, 2 and so on.
    on_point = F.get(F.lit(found.points or [0.0]), at - 1) == F.col("__value")
    hot = F.get(F.lit(found.hot or [False]), at - 1) & on_point
    base = 2 * at - F.when(on_point, 1).otherwise(0)
    null_base = F.lit(-1 if nulls_first else 2 * len(found.points) + 1)
    known = F.col("__value").isNotNull()
    split = F.when(known, hot).otherwise(F.lit(found.hot_nulls))
    within = F.when(split & F.col("__key").isNotNull(), F.col("__tie").cast("bigint") + 1)
    base = F.when(known, base).otherwise(null_base).cast("bigint")
    return placed.select(
        *columns, base.alias(BASE),
        (base * (len(found.ties) + 2) + F.coalesce(within, F.lit(0))).alias(BLOCK))


def _before(blocks: DataFrame, value: str) -> Column:
    """Sum of a block value over all earlier blocks. There is one row per block."""
    return F.sum(value).over(Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1))


def _ranked(rows: DataFrame, value: str, tie: str) -> tuple[DataFrame, list[Column]]:
    """Rows in blocks of descending value, and the order within a block.

    Rows that took work are kept in memory, as far as there is room, for the passes that follow; what
    is lost or evicted is made again, and is the same. The mark keeps any other query off them.
    """
    kept = rows.withColumn("__run", F.lit(uuid.uuid4().hex)).persist(StorageLevel.MEMORY_ONLY)
    return with_block(kept, -F.col(value), tie), [F.desc(value), F.asc(tie)]


def ntile(rows: DataFrame, tiles: int, value: str, tie: str, name: str) -> DataFrame:
    """SQL ``NTILE`` over the whole table, highest ``value`` first and ``tie`` within equal ones.

    Sizes differ by one at most, larger tiles first. ``tie`` is unique. The result is in order:
    blocks are range partitioned once, which serves the window and the order.
    """
    placed, order = _ranked(rows, value, tie)
    counts = placed.groupBy(BLOCK).agg(F.count("*").alias("__rows"))
    offsets = counts.select(
        BLOCK,
        F.coalesce(_before(counts, "__rows"), F.lit(0)).alias("__before"),
        F.sum("__rows").over(Window.partitionBy()).alias("__total"),
    )
    tile = F.expr("""
        CASE WHEN __number < __larger * (__small + 1)
             THEN __number div (__small + 1) + 1
             ELSE __larger + (__number - __larger * (__small + 1)) div greatest(__small, 1) + 1
        END
    """)
    return (
        placed.repartitionByRange(BLOCK)
        .withColumn(PLACE, F.row_number().over(Window.partitionBy(BLOCK).orderBy(*order)) - 1)
        .join(F.broadcast(offsets), BLOCK)  # one row per block
        .orderBy(BLOCK, PLACE)
        .withColumns({
            "__number": F.col("__before") + F.col(PLACE),
            "__small": F.floor(F.col("__total") / tiles),
            "__larger": F.col("__total") % tiles,
        })
        .withColumn(name, tile)
        .select(*rows.columns, name)
    )


def running_total(
    rows: DataFrame, sums: list[str], value: str, tie: str, names: list[str], totals: list[str],
) -> DataFrame:
    """Running and grand totals of the columns ``sums``, highest ``value`` first.

    ``tie`` is unique. The result is in order.
    """
    placed, order = _ranked(rows, value, tie)
    in_block = placed.groupBy(BLOCK).agg(*[F.sum(c).alias(c) for c in sums])
    offsets = in_block.select(
        BLOCK,
        *[_before(in_block, c).alias(f"__before_{c}") for c in sums],
        *[F.sum(c).over(Window.partitionBy()).alias(t) for c, t in zip(sums, totals, strict=True)],
    )
    local = Window.partitionBy(BLOCK).orderBy(*order)
    until = local.rowsBetween(Window.unboundedPreceding, 0)

    def both(column: str) -> Column:
        before, own = F.col(f"__before_{column}"), F.col(f"__local_{column}")
        kind = rows.schema[column].dataType
        if isinstance(kind, T.DecimalType):
            # A sum of two widest decimals would lose a place.
            kind = T.DecimalType(min(kind.precision + 10, 37), kind.scale)
            before, own = before.cast(kind), own.cast(kind)
        return F.coalesce(before + own, own, before)

    return (
        placed.repartitionByRange(BLOCK)
        .withColumns({f"__local_{c}": F.sum(c).over(until) for c in sums})
        .withColumn(PLACE, F.row_number().over(local))
        .join(F.broadcast(offsets), BLOCK)  # one row per block
        .orderBy(BLOCK, PLACE)
        .select(*rows.columns, *[both(c).alias(n) for c, n in zip(sums, names, strict=True)],
                *totals)
    )


def dense_rank(rows: DataFrame, group: list[str], value: str, tie: str, name: str) -> DataFrame:
    """``DENSE_RANK`` per group, highest ``value`` first. ``tie`` only splits hot values."""
    placed, _ = _ranked(rows, value, tie)
    # A struct of the group columns is never null, so null groups join as any other.
    placed = placed.withColumn(GROUP, F.struct(*group))
    within = Window.partitionBy(GROUP, BLOCK).orderBy(F.desc(value))
    local = placed.withColumn("__rank", F.dense_rank().over(within))
    ends = local.groupBy(GROUP, BLOCK, BASE).agg(F.max("__rank").alias("__distinct"))
    across = Window.partitionBy(GROUP).orderBy(BLOCK)  # at most one row per block
    # Blocks of one value have one rank together.
    counted = F.when(F.lead(BASE).over(across) == F.col(BASE), 0).otherwise(F.col("__distinct"))
    earlier = F.sum("__counted").over(across.rowsBetween(Window.unboundedPreceding, -1))
    offsets = ends.withColumn("__counted", counted).select(
        GROUP, BLOCK, F.coalesce(earlier, F.lit(0)).alias("__offset"))
    return (
        local.join(offsets, [GROUP, BLOCK])
        .withColumn(name, F.col("__rank") + F.col("__offset"))
        .select(*rows.columns, name)
    )


def hot_keys(rows: DataFrame, key: str, parts: int) -> dict:
    """Keys with more rows than a fair part of ``parts``, and how many fair parts they fill.

    A sketch of heavy hitters, merged over all tasks, finds them in one aggregation. There are fewer
    than ``parts`` such keys, so that many are asked for, but at most ``MOST_HOT_KEYS``.
    """
    most = min(max(parts, 2), MOST_HOT_KEYS)
    found = rows.agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {most * TRACKED_PER_KEY})").alias("top"),
        F.count(key).alias("rows"),
    ).first()
    fair = found.rows / most
    return {r.item: math.ceil(r["count"] / fair) for r in found.top or []
            if r.item is not None and r["count"] > fair}


def salted_join(rows: DataFrame, side: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Inner join of many rows to a side with unique keys; a hot key is dealt over several tasks.

    Only keys that are hot are salted, each in proportion to its rows, and only their rows of the
    side are repeated.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(rows, key, 2 * partitions)
    if not hot:
        return rows.join(side, key)
    salts = F.coalesce(F.try_element_at(
        F.create_map(*[F.lit(v) for pair in hot.items() for v in pair]), F.col(key)), F.lit(1))
    salt = "__salt"
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(spread_by), salts).cast("int"))
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    return dealt.join(side.withColumn(salt, every), [key, salt]).drop(salt)
