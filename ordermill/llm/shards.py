"""Shards over fixed virtual slots.

A record's id is hashed into one of ``SLOTS`` slots, for good. A versioned map says which shard
holds each slot. Maps are stored, a folder per version, and readers take the version they are told or
the latest one; growing or rebalancing reads a version, edits it and publishes the next, and moves
whole slots. Ids need no coordination, and a map has the same size for any number of records.

Nulls: a null id has a slot of its own hash; a null text has size 16. Repeated rows are separate
records of the same slot; a slot with many rows, whatever their ids are, is dealt over several
tasks. A text of any length is one record. An empty table gives an empty result. Other columns of
the table are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.words import stored

SLOTS = 16_384
RECORD_BYTES = 16
#: A slot with so many times its fair number of rows is dealt over so many parts.
HOT_FACTOR = 8
PARTS = 64


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each virtual slot; every edit makes a new version."""

    version: int
    shards: int
    owner: tuple[int, ...]

    @staticmethod
    def first(slots: int = SLOTS) -> SlotMap:
        return SlotMap(1, 1, (0,) * slots)

    def grown(self) -> SlotMap:
        """One more shard, which takes its even share of slots, each from the fullest shard."""
        held: list[list[int]] = [[] for _ in range(self.shards)]
        for slot, shard in enumerate(self.owner):
            held[shard].append(slot)
        owner, new = list(self.owner), self.shards
        full = [(-len(h), shard) for shard, h in enumerate(held)]
        heapq.heapify(full)
        for _ in range(len(owner) // (new + 1)):
            n, shard = heapq.heappop(full)
            owner[held[shard].pop()] = new
            heapq.heappush(full, (n + 1, shard))
        return SlotMap(self.version + 1, new + 1, tuple(owner))

    @staticmethod
    def of(shards: int, slots: int = SLOTS) -> SlotMap:
        """The map after growing from one shard; it depends on the two numbers alone."""
        found = SlotMap.first(slots)
        while found.shards < shards:
            found = found.grown()
        return found

    def rebalanced(self, slot_bytes: dict[int, int], tolerance: float = 0.02) -> SlotMap:
        """Moves slots from the largest to the smallest shard until all are near the mean.

        ``slot_bytes`` comes from :func:`slot_sizes`, at most one number per slot.
        """
        size, held = [0] * self.shards, [[] for _ in range(self.shards)]
        for slot, shard in enumerate(self.owner):
            size[shard] += slot_bytes.get(slot, 0)
            held[shard].append(slot)
        mean, owner = sum(size) / self.shards, list(self.owner)
        for _ in owner:
            top, low = max(range(self.shards), key=size.__getitem__), min(
                range(self.shards), key=size.__getitem__)
            gap = size[top] - size[low]
            if gap <= tolerance * mean:
                break
            fit = [s for s in held[top] if 0 < slot_bytes.get(s, 0) < gap]
            if not fit:
                break
            slot = min(fit, key=lambda s: (abs(slot_bytes[s] - gap / 2), s))
            held[top].remove(slot)
            held[low].append(slot)
            size[top] -= slot_bytes[slot]
            size[low] += slot_bytes[slot]
            owner[slot] = low
        return SlotMap(self.version + 1, self.shards, tuple(owner))

    def publish(self, spark: SparkSession, folder: str) -> None:
        """Stores the map as its version, which must not be there yet."""
        rows = [(slot, shard) for slot, shard in enumerate(self.owner)]
        (spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1)
         .write.mode("error").parquet(f"{folder}/version={self.version}"))

    @staticmethod
    def load(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
        """A stored version, or the latest one."""
        maps = stored_maps(spark, folder)
        if version is None:
            version = maps.agg(F.max("version")).first()[0]
        # One row per slot, whatever the number of records is.
        own = sorted(maps.filter(F.col("version") == version).collect(),
                     key=lambda r: r.virtual_slot)
        return SlotMap(version, max(r.shard for r in own) + 1, tuple(r.shard for r in own))


def stored_maps(spark: SparkSession, folder: str) -> DataFrame:
    """``version, virtual_slot, shard`` of all stored maps."""
    return (spark.read.schema("virtual_slot int, shard int, version int").parquet(folder)
            .select("version", "virtual_slot", "shard"))


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``virtual_slot, rows, bytes`` of a table with ``doc_id`` and ``size``."""
    return (records.groupBy(virtual_slot(F.col("doc_id"), slots).alias("virtual_slot"))
            .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")))


def assign(docs: DataFrame, folder: str, version: int, grown_version: int) -> DataFrame:
    """Each document's shard under two stored versions of the map, and its place in its shard.

    A place is the number of records in the shard's earlier slots plus the place in the own slot;
    only the counts, one per slot or part of a hot slot, are ever seen together.
    """
    spark = docs.sparkSession
    maps = stored_maps(spark, folder)
    owner = maps.filter(F.col("version") == version).drop("version")
    grown = (maps.filter(F.col("version") == grown_version)
             .select("virtual_slot", F.col("shard").alias("grown_shard")))
    slots = owner.count()
    # Written once, so that a record's part of its slot is the same for every later pass.
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        record_size(F.col("text")).alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).alias("text_crc32"),
        F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int").alias("part"),
    ).withColumn("virtual_slot", virtual_slot(F.col("doc_id"), slots)), "records")
    sizes = stored(slot_sizes(rows, slots), "slot-sizes")
    fair = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] / slots
    hot = sizes.filter(F.col("rows") > HOT_FACTOR * fair + PARTS).select("virtual_slot")
    # At most one row per virtual slot, whatever the table's size.
    rows = (rows.join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), "virtual_slot", "left")
            .withColumn("part", F.when(F.col("is_hot"), F.col("part")).otherwise(0)))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("rows"))
               .join(sizes.select("virtual_slot", "bytes"), "virtual_slot")
               .join(owner, "virtual_slot").join(grown, "virtual_slot")
               .withColumn("ahead", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows"))
    inside = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("place", F.row_number().over(inside))
            .join(offsets, ["virtual_slot", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"),
                    "shard", (F.col("ahead") + F.col("place") - 1).cast("long").alias("slot"),
                    "grown_shard", "virtual_slot", F.col("bytes").alias("slot_bytes"),
                    F.lit(version).alias("map_version")))
