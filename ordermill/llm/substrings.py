"""Removal of passages that occur more than once, by suffix automata of reference shards.

A passage is a window of ``LENGTH`` consecutive words. The corpus is its own reference, so sending
automata of all of it to every executor would cost the square of its size. Instead both sides are
dealt out by anchors: of the word runs of ``GRAM`` words inside a window, the one with the smallest
hash is the window's anchor, and equal windows have equal anchors. A stretch of text whose windows
share one anchor is a region; each window lies in exactly one region.

Only anchors that occur more than once matter. Their regions go to the reference shard of the
anchor, equal regions once, with their number. A shard's task builds a suffix automaton of its
regions with occurrence counts and streams the regions through it: matching statistics give, at
each word, the longest ending passage that occurs at least twice, and passages of at least
``LENGTH`` words become spans. Words under spans are removed.

An anchor with more than ``HOT_REGIONS`` different regions (a common phrase in ever new contexts)
would fill one task. The windows of such regions are counted by hash instead, summed on the map
side, which gives the same spans.

Texts with the same words are one reference text; with ``LENGTH`` words or more all of its copies
vanish. Nulls: a null text has no words; a null id is an id like others. Repeated rows are copies
of each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.words import gram_hashes, keyed, map_batches, stored, texts, word_hashes

LENGTH = 35
GRAM = 16
HOT_REGIONS = 2_000
SHARD_REGIONS = 1_000


def anchors(words: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple:
    """Anchor hash, first window and last window of each region of a text."""
    grams = gram_hashes(words, gram)
    span = length - gram + 1
    if len(grams) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    windows = np.lib.stride_tricks.sliding_window_view(grams, span)
    chosen = windows.argmin(axis=1) + np.arange(len(windows))
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], len(chosen)) - 1
    return (grams[chosen[first]].view(np.int64), first.astype(np.int32), last.astype(np.int32))


class SuffixAutomaton:
    """All passages of some word sequences, with the number of their occurrences."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the shorter passages of ``target`` that ``state`` reaches by ``word``."""
        step, link = self.step, self.link
        own = self._state(self.length[state] + 1, step[target].copy(), link[target])
        while state >= 0 and step[state].get(word) == target:
            step[state][word] = own
            state = link[state]
        link[target] = own
        return own

    def add(self, words: list[int], weight: int) -> None:
        step, link, length = self.step, self.link, self.length
        last = 0
        for word in words:
            target = step[last].get(word)
            if target is not None:
                last = (target if length[target] == length[last] + 1
                        else self._split(last, word, target))
            else:
                state = last
                last = self._state(length[state] + 1, {}, 0)
                while state >= 0 and word not in step[state]:
                    step[state][word] = last
                    state = link[state]
                if state >= 0:
                    target = step[state][word]
                    link[last] = (target if length[target] == length[state] + 1
                                  else self._split(state, word, target))
            self.count[last] += weight

    def close(self) -> None:
        """Passes occurrence counts on to shorter endings."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list[int], least: int) -> tuple[list[int], list[int]]:
        """Spans of words under passages of ``least`` words or more that occur at least twice."""
        step, link, length, count = self.step, self.link, self.length, self.count
        state = matched = 0
        begin: list[int] = []
        end: list[int] = []
        for at, word in enumerate(words, 1):
            while True:
                target = step[state].get(word)
                if target is not None and count[target] > 1:
                    state, matched = target, matched + 1
                    break
                if state == 0:
                    matched = 0
                    break
                state = link[state]
                matched = length[state]
            if matched >= least:
                if end and at - matched <= end[-1]:
                    end[-1] = at
                else:
                    begin.append(at - matched)
                    end.append(at)
        return begin, end


def shard_spans(regions: pa.Table, least: int) -> pa.Table:
    """``region, begin, end`` of the regions of one shard that hold a repeated passage."""
    keys, bodies = regions.column("region").to_pylist(), regions.column("body").to_pylist()
    weights, marks = regions.column("weight").to_pylist(), regions.column("anchor").to_pylist()
    known: dict[int, int] = {}
    for mark in marks:
        known[mark] = known.get(mark, 0) + 1
    numbers: dict[bytes, int] = {}
    automaton = SuffixAutomaton()
    found: list[tuple] = []
    open_rows: list[tuple] = []
    for key, body, weight, mark in zip(keys, bodies, weights, marks, strict=True):
        words = [numbers.setdefault(w, len(numbers)) for w in body.split(b" ")]
        if known[mark] > 1:
            automaton.add(words, weight)
            open_rows.append((key, words))
        elif weight > 1:  # the one region of its anchor, several times
            found.append((key, [0], [len(words)]))
    automaton.close()
    for key, words in open_rows:
        begin, end = automaton.repeated(words, least)
        if begin:
            found.append((key, begin, end))
    kinds = {"region": pa.binary(), "begin": pa.list_(pa.int32()), "end": pa.list_(pa.int32())}
    return pa.table({n: pa.array([f[i] for f in found], t)
                     for i, (n, t) in enumerate(kinds.items())})


def sketches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, n_words, digest, same, anchors``; the digest is of the words joined by spaces.

    ``same`` is a hash of the text itself, which Spark can compute beside it once more.
    """
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            sizes, digests, found = [], [], []
            for data in texts(batch.column("text")):
                words = word_hashes(data)
                sizes.append(len(words))
                digests.append(hashlib.sha256(b" ".join(data.split())).hexdigest())
                found.append(anchors(words, length, gram)[0])
            return {"doc_id": batch.column("doc_id"), "n_words": sizes, "digest": digests,
                    "same": batch.column("same"), "anchors": found}

        return work

    return map_batches(keyed(docs).withColumn("same", F.xxhash64("text")), make, "doc_id long, "
                       "n_words long, digest string, same long, anchors array<long>")


def _bodies(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``digest, body, anchor, first, last``: texts with their regions of repeated anchors.

    Rows whose text has not the digest beside it are dropped.
    """
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n in ("digest", "body", "anchor", "first", "last")}
            wanted, digests = (batch.column(n).to_pylist() for n in ("wanted", "digest"))
            for data, own, digest in zip(texts(batch.column("text")), wanted, digests,
                                         strict=True):
                body = b" ".join(data.split())
                if hashlib.sha256(body).hexdigest() != digest:
                    continue
                mark, first, last = anchors(word_hashes(body), length, gram)
                keep = np.isin(mark, np.array(own, np.int64))
                for name, value in zip(out, (digest, body, mark[keep], first[keep], last[keep]),
                                       strict=True):
                    out[name].append(value)
            return out

        return work

    return map_batches(rows, make, "digest string, body binary, anchor array<long>, "
                       "first array<int>, last array<int>")


def _regions(bodies: DataFrame, length: int) -> DataFrame:
    """``digest, anchor, region, body, first``: one row per region."""
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n in ("digest", "anchor", "region", "body", "first")}
            columns = [batch.column(n).to_pylist() for n in ("digest", "body", "anchor", "first",
                                                             "last")]
            for digest, body, marks, firsts, lasts in zip(*columns, strict=True):
                words = body.split(b" ")
                for mark, first, last in zip(marks, firsts, lasts, strict=True):
                    own = b" ".join(words[first:last + length])
                    for name, value in zip(out, (digest, mark, xxhash.xxh3_128_digest(own), own,
                                                 first), strict=True):
                        out[name].append(value)
            return out

        return work

    return map_batches(bodies, make,
                       "digest string, anchor long, region binary, body binary, first int")


def _hot_spans(regions: DataFrame, length: int) -> DataFrame:
    """The same as :func:`shard_spans`, by counting windows; no group is ever held in one place."""
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n in ("region", "window", "at", "weight")}
            columns = [batch.column(n).to_pylist() for n in ("region", "body", "weight")]
            for region, body, weight in zip(*columns, strict=True):
                words = body.split(b" ")
                for at in range(len(words) - length + 1):
                    own = xxhash.xxh3_128_digest(b" ".join(words[at:at + length]))
                    for name, value in zip(out, (region, own, at, weight), strict=True):
                        out[name].append(value)
            return out

        return work

    rows = map_batches(regions.select("region", "body", "weight"), make,
                       "region binary, window binary, at int, weight long")
    often = rows.groupBy("window").agg(F.sum("weight").alias("n")).filter("n > 1").select("window")
    return (rows.join(often, "window").groupBy("region")
            .agg(F.sort_array(F.collect_list("at")).alias("begin"))
            .withColumn("end", F.transform("begin", lambda a: a + length)))


def _kept(bodies: DataFrame) -> DataFrame:
    """``digest, begin, end, kept``: merged spans, and the words outside of them."""
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n in ("digest", "begin", "end", "kept")}
            columns = [batch.column(n).to_pylist() for n in ("digest", "body", "spans")]
            for digest, body, found in zip(*columns, strict=True):
                words = body.split(b" ")
                gone = np.zeros(len(words) + 1, np.int32)
                for span in found:
                    gone[span["begin"]] += 1
                    gone[span["end"]] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
                for name, value in zip(out, (digest, edge[::2], edge[1::2], kept.decode()),
                                       strict=True):
                    out[name].append(value)
            return out

        return work

    return map_batches(bodies, make,
                       "digest string, begin array<int>, end array<int>, kept string")


def repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                      hot_regions: int = HOT_REGIONS) -> DataFrame:
    """``doc_id, n_words, n_removed, begin, end, kept_sha256`` of each document.

    ``begin`` and ``end`` are the removed spans, in words; ``kept_sha256`` is of the other words
    joined by one space.
    """
    known = stored(sketches(docs, length, gram), "sketches")
    # One row stands for all texts of a digest: ids may repeat with other texts, or be null.
    classes = (known.filter(F.col("n_words") >= length).groupBy("digest")
               .agg(F.min(F.struct("doc_id", "same")).alias("rep"), F.count("*").alias("copies")))
    classes = classes.withColumn("class", F.xxhash64("digest"))
    single = (known.join(classes, "digest")
              .filter(F.col("doc_id").eqNullSafe(F.col("rep.doc_id"))
                      & (F.col("same") == F.col("rep.same")))
              .dropDuplicates(["digest"]))
    places = stored(single.select("class", F.explode("anchors").alias("anchor")), "anchors")
    # Stored, so that the join with a hot anchor's places is one that Spark can split.
    twice = stored(places.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
                   .select("anchor"), "repeated")
    # One list per class, no longer than its text. Should two digests share a class number, both
    # get the anchors of both, and each text keeps those that it has.
    wanted = (places.join(twice, "anchor").groupBy("class")
              .agg(F.collect_set("anchor").alias("wanted")))
    wanted = wanted.join(classes, "class").select(
        "digest", "wanted", F.col("rep.doc_id").alias("rep"), F.col("rep.same").alias("same"))
    own = keyed(docs).withColumn("same", F.xxhash64("text"))
    rows = own.join(wanted, own.doc_id.eqNullSafe(wanted.rep) & (own.same == wanted.same)).select(
        "text", "digest", "wanted")
    bodies = stored(_bodies(rows, length, gram).dropDuplicates(["digest"]), "bodies")

    regions = _regions(bodies, length)
    different = stored(regions.groupBy("region").agg(
        F.min("anchor").alias("anchor"), F.min("body").alias("body"),
        F.count("*").alias("weight")), "regions")
    sizes = different.groupBy("anchor").agg(F.count("*").alias("n"))
    crowded = sizes.filter(F.col("n") > hot_regions).select("anchor")
    shards = max(1, different.count() // SHARD_REGIONS)
    kind = "region binary, begin array<int>, end array<int>"

    def work(table: pa.Table) -> pa.Table:
        return shard_spans(table, length)

    cool = (different.join(crowded, "anchor", "left_anti")
            .groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"))
            .applyInArrow(work, kind))
    hot = _hot_spans(different.join(crowded, "anchor", "left_semi"), length)
    spans = (cool.unionByName(hot.select("region", "begin", "end"))
             .select("region", F.explode(F.arrays_zip("begin", "end")).alias("span")))
    found = (regions.select("digest", "region", "first").join(spans, "region")
             .groupBy("digest").agg(F.collect_list(F.struct(
                 (F.col("first") + F.col("span.begin")).alias("begin"),
                 (F.col("first") + F.col("span.end")).alias("end"))).alias("spans")))
    gone = _kept(bodies.select("digest", "body").join(found, "digest"))

    empty = F.array().cast("array<int>")
    whole = F.coalesce(F.col("copies") > 1, F.lit(False))
    n = F.col("n_words").cast("int")
    begin = F.when(whole, F.array(F.lit(0))).otherwise(F.coalesce("begin", empty))
    end = F.when(whole, F.array(n)).otherwise(F.coalesce("end", empty))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    kept = F.when(whole, nothing).otherwise(F.coalesce(F.sha2("kept", 256), F.col("digest")))
    return (known.drop("anchors", "same").join(classes.select("digest", "copies"), "digest", "left")
            .join(gone, "digest", "left")
            .select("doc_id", "n_words", begin.alias("begin"), end.alias("end"),
                    kept.alias("kept_sha256"))
            .withColumn("n_removed", F.aggregate(
                F.zip_with("end", "begin", lambda e, b: e - b), F.lit(0).cast("long"),
                lambda a, x: a + x)))
