"""Near duplicates by one-permutation MinHash.

A document's set are its distinct runs of five words, as 64-bit hashes. One permutation deals the
set over ``BINS`` bins; a bin's value is its smallest hash, and an empty bin takes the value of the
first filled bin in an order of its own (optimal densification). Each run of ``ROWS`` bins is a
band; documents with an equal band share a bucket.

Documents with equal sets are one class, linked to its smallest id, so only classes are compared.
Within a bucket, candidates are a star: its smallest id with each other member, never all pairs.
Links are confirmed on the full sets, and connected components follow.

A star misses two members that resemble each other but not the centre. So the members of buckets
that still hold several components are indexed a second time, exactly: of their sets, each ordered
from rare to common, two similar ones share a shingle among their first quarters. A list of such a
shingle holds mostly one component; each other member is compared with the members of other
components, where sizes and the shingle's places leave room for enough common ones.

Two sets whose similarity is just 0.75 share no bucket with a probability of
``(1 - 0.75 ** ROWS) ** BANDS``, 5e-6; it falls steeply above.

Results per document: ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``. Nulls: a
null or empty text has an empty set and is linked with nothing; a null id is linked with nothing
and kept. Rows that share an id are one document, which is linked by any of its texts. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.graph import components, merged
from ordermill.llm.words import gram_hashes, keyed, map_batches, mixed, stored, texts, word_hashes

SHINGLE = 5
ROWS = 4
BANDS = 32
BINS = ROWS * BANDS
PERCENT = 75


def shingle_set(data: bytes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = word_hashes(data.lower())
    if 0 < len(words) < SHINGLE:
        return gram_hashes(words, len(words))
    return np.unique(gram_hashes(words, SHINGLE))


def probe_order(bins: int = BINS) -> np.ndarray:
    """For each bin the order in which it looks for a filled bin, beginning with itself."""
    order = np.argsort(mixed(np.arange(bins * bins, dtype=np.uint64)).reshape(bins, bins), axis=1)
    own = np.arange(bins)[:, None]
    rest = order[order != own].reshape(bins, bins - 1)
    return np.hstack([own, rest])


def signature(hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin, densified; ``hashes`` are sorted and not empty."""
    bins = len(order)
    width = np.uint64(2**64 // bins)
    at = np.searchsorted(hashes, np.arange(bins, dtype=np.uint64) * width)
    value = hashes[np.minimum(at, len(hashes) - 1)]
    filled = (at < len(hashes)) & (np.minimum(value // width, bins - 1) == np.arange(bins))
    return value[order[np.arange(bins), filled[order].argmax(axis=1)]]


def bands(hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """One bucket key per band."""
    rows = signature(hashes, order).reshape(BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        total = mixed(total) + rows[:, i]
    return mixed(total).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, bands``; empty sets have neither digest nor bands."""
    def make():
        order = probe_order()

        def work(batch: pa.RecordBatch) -> dict:
            sizes, digests, keys = [], [], []
            for data in texts(batch.column("text")):
                own = shingle_set(data)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                keys.append(bands(own, order) if len(own) else [])
            return {"doc_id": batch.column("doc_id"), "n_shingles": sizes, "digest": digests,
                    "bands": keys}

        return work

    return map_batches(keyed(docs), make,
                       "doc_id long, n_shingles long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n, shingles`` with the whole set of each document."""
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(t).view(np.int64) for t in texts(batch.column("text"))]
            return {"doc_id": batch.column("doc_id"), "n": [len(s) for s in sets],
                    "shingles": sets}

        return work

    return map_batches(keyed(docs), make, "doc_id long, n long, shingles array<long>")


def rare_pairs(sets: DataFrame, labels: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Candidates ``a, b`` among some sets, for all similar pairs of different components.

    ``labels`` has ``doc_id, label`` of each set that is linked yet.
    """
    known = (sets.join(labels, "doc_id", "left")
             .select("doc_id", "n", F.coalesce("label", "doc_id").alias("label"),
                     F.xxhash64("shingles").alias("own"), F.explode("shingles").alias("shingle")))
    common = known.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    # Shingles of one set alone come first in the order but need no list.
    by_rarity = Window.partitionBy("doc_id", "own")
    shared = (known.join(common, "shingle")
              .withColumn("place", F.col("n") - F.count("*").over(by_rarity) - 1
                          + F.row_number().over(by_rarity.orderBy("df", "shingle"))))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    lists = stored(shared.filter(F.col("place") < first)
                   .select("shingle", "doc_id", "n", "label", "place"), "lists")
    held = lists.groupBy("shingle", "label").agg(F.count("*").alias("members"))
    mixed_lists = stored(
        held.groupBy("shingle")
        .agg(F.max_by("label", "members").alias("most"), F.count("*").alias("labels"))
        .filter("labels > 1").select("shingle", "most"), "mixed")
    own = lists.join(mixed_lists, "shingle").filter("label != most").drop("most").alias("x")
    other = lists.alias("y")
    need = F.ceil((F.col("x.n") + F.col("y.n")) * percent / (100 + percent))
    room = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    return (own.join(other, (F.col("x.shingle") == F.col("y.shingle"))
                     & (F.col("x.label") != F.col("y.label")) & (room >= need))
            .select(F.least("x.doc_id", "y.doc_id").alias("a"),
                    F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct())


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"),
                       F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"),
                        F.col("shingles").alias("sb"))
    # Sizes alone rule out many pairs before their sets meet.
    close = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(right, "b").join(left, "a").filter(close)
            .filter(100 * common >= percent * (F.col("na") + F.col("nb") - common))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each document."""
    known = stored(sketches(docs), "sketches")
    named = known.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    copies = (named.select("doc_id", "digest").join(classes, "digest")
              .filter("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    rows = (named.join(classes, "digest").filter("doc_id = rep")
            .select("doc_id", F.explode("bands").alias("key")))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = stored(rows.join(shared, "key").dropDuplicates(["key", "doc_id"]), "buckets")

    wanted = members.select("doc_id").distinct()
    sets = stored(shingle_sets(keyed(docs).join(wanted, "doc_id"))
                  .dropDuplicates(["doc_id", "shingles"]), "sets")

    # Stored, so that the join with a hot bucket's members is one that Spark can split.
    centres = stored(members.groupBy("key").agg(F.min("doc_id").alias("a")), "centres")
    stars = (members.withColumnRenamed("doc_id", "b").join(centres, "key").filter("a != b")
             .select("a", "b").distinct())
    found = confirmed(stars, sets, percent)
    labels = stored(components(copies.union(found)), "labels")

    named_members = (members.join(labels, "doc_id", "left")
                     .select("key", "doc_id", F.coalesce("label", "doc_id").alias("label")))
    several = (named_members.groupBy("key")
               .agg(F.min("label").alias("low"), F.max("label").alias("high"))
               .filter("low < high").select("key"))
    open_docs = members.join(several, "key").select("doc_id").distinct()
    open_sets = stored(sets.join(open_docs, "doc_id"), "open")
    rest = confirmed(rare_pairs(open_sets, labels, percent), open_sets, percent)
    labels = stored(merged(labels, stored(rest, "links")), "labels")

    return (known.join(labels, "doc_id", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("label", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that stay: one of each component, with all their columns.

    Of rows that share an id, the smallest text stays.
    """
    marks = near_duplicates(docs, percent)
    keep = marks.filter("kept").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(keep, "doc_id", "left_semi")
    twice = (docs.groupBy("doc_id").agg(F.count("*").alias("n"))
             .filter("n > 1 and doc_id is not null").select("doc_id"))
    # Ids are unique in a sound table, so this window sees next to nothing.
    again = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first())
    single = (named.join(twice, "doc_id", "left_semi")
              .withColumn("__place", F.row_number().over(again)).filter("__place = 1")
              .drop("__place"))
    return (named.join(twice, "doc_id", "left_anti").unionByName(single)
            .unionByName(docs.filter("doc_id is null")))
