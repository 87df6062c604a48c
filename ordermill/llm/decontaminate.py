"""Benchmark decontamination with an FM-index per shard of training text.

A benchmark item's windows are its runs of ``WINDOW`` consecutive words; a shorter item is one
window. Every task cuts its documents into shards and indexes each one: words become numbers of the
benchmark's vocabulary, the sorted suffixes give the Burrows-Wheeler transform, and a wavelet
matrix answers how often a number occurs before a place. All windows are searched backwards at once;
occurrences are located by walking to the next sampled suffix. The words under all occurrences are
hit; ``cleaned`` removes them, merged into spans.

Only runs of words that can belong to a window, because each neighbouring pair of them occurs in
the benchmark, are put into the index; all else in a text cannot match and acts as a separator.

The benchmark is the stated query set. It is written as a table in blocks of about ``BLOCK_WORDS``
words, or of one longer item. Tasks read a block, search it in their documents and free it before
the next one; the hits are merged by document. So neither the driver nor a worker holds more than a
block.

Nulls: a null text or item has no words; an item without words or without an id never occurs.
Repeated rows are judged one by one. A text of any length is searched whole. An empty benchmark
hits nothing, an empty table gives an empty result. Other columns of ``benchmark`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.tokenfile import place
from ordermill.llm.words import keyed, map_batches, on_texts
from ordermill.session import new_scratch

WINDOW = 10
SHARD_WORDS = 400_000
BLOCK_WORDS = 2_000_000
SAMPLE_EVERY = 8

# A-Z become lower case; all other bytes below 0x80 but digits and a-z separate words.
TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39
                 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
WORD = re.compile(rb"[^ ]+")


def words_of(data: bytes) -> list[bytes]:
    return data.translate(TO_WORDS).split()


class Windows:
    """The windows of benchmark items as rows of word numbers, and which items have them."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, data in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(data)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i:i + window]), set()).add(name)
        self.groups: list[tuple[np.ndarray, list[list[str]]]] = []
        for size in sorted({len(w) for w in found}):
            own = [w for w in found if len(w) == size]
            self.groups.append((np.array(own, np.int64), [sorted(found[w]) for w in own]))
        self.shortest = min((g.shape[1] for g, _ in self.groups), default=0)
        pairs = [g[:, i] * (len(self.vocabulary) + 1) + g[:, i + 1]
                 for g, _ in self.groups for i in range(g.shape[1] - 1)]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        # A table over hashed pairs may let a few more pairs in, never fewer.
        self.pair_bits = np.zeros(1 << 20, bool)
        self.pair_bits[self._place(self.pairs)] = True

    @staticmethod
    def _place(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(
            np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def indexable(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in runs that may hold a window, and each place's run's first place.

        Such a run is long enough and all its neighbours are known pairs.
        """
        n = len(numbers)
        joined = np.zeros(n + 1, bool)  # place i is a known pair with the place before it
        pair = numbers[:-1] * (len(self.vocabulary) + 1) + numbers[1:]
        joined[1:n] = (numbers[:-1] > 0) & (numbers[1:] > 0) & self.pair_bits[self._place(pair)]
        begin = np.flatnonzero(~joined[:n])
        length = np.diff(np.append(begin, n))
        fit = (length >= self.shortest) & ((length > 1) | (numbers[begin] > 0))
        places = np.flatnonzero(np.repeat(fit, length))
        return places, np.repeat(begin, length)[places]


class FmIndex:
    """Suffix order, its transform and a wavelet matrix over one shard's numbers.

    ``runs`` is the text: numbers from 1 up, with 0 as separator before each run and at the end.
    Each separator sorts by its place, before all words, so suffixes differ within their run.
    """

    def __init__(self, runs: np.ndarray, size: int):
        n = len(runs)
        separators = np.flatnonzero(runs == 0)
        rank = runs + len(separators)
        rank[separators] = np.arange(len(separators))
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:n - width] = rank[width:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], sorted_key[1:] != sorted_key[:-1])))
            if rank[order[-1]] == n - 1 or width >= n:
                break
            width *= 2
        self.n = n
        last = runs[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(runs, minlength=size + 1))))
        # Sampled: every few places, and each run's first, as no walk crosses a separator.
        sampled = (order % SAMPLE_EVERY == 0) | (last == 0)
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = order[sampled]
        self.levels: list[np.ndarray] = []
        self.zeros: list[int] = []
        self.bits = max(1, int(size).bit_length())
        for level in range(self.bits - 1, -1, -1):
            bit = (last >> level) & 1
            self.levels.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            zeros = np.flatnonzero(bit == 0)
            self.zeros.append(len(zeros))
            last = np.concatenate((last[zeros], last[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each place."""
        low, high = np.zeros_like(place), place
        for level, (ones, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            a, b = ones[low], ones[high]
            low = np.where(bit, zeros + a, low - a)
            high = np.where(bit, zeros + b, high - b)
        return high - low

    def symbol(self, place: np.ndarray) -> np.ndarray:
        found = np.zeros_like(place)
        for ones, zeros in zip(self.levels, self.zeros, strict=True):
            a = ones[place]
            bit = ones[place + 1] - a
            found = found * 2 + bit
            place = np.where(bit, zeros + a, place - a)
        return found

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pattern the range of suffixes that begin with it."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        for i in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[:, i]
            low = self.first[symbol] + self.rank(symbol, low)
            high = self.first[symbol] + self.rank(symbol, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text places of suffixes."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            at = rows[walking]
            symbol = self.symbol(at)
            rows[walking] = self.first[symbol] + self.rank(symbol, at)
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.samples[self.sample_rank[rows]] + steps


def shard_hits(windows: Windows, documents: list[np.ndarray]) -> tuple[list, list]:
    """Hit flags per word, and names of occurring items, for each document of one shard."""
    hits = [np.zeros(len(d) + 1, np.int32) for d in documents]
    names: list[set[str]] = [set() for _ in documents]
    pieces, origin, owner = [], [], []
    for at, numbers in enumerate(documents):
        if not len(numbers) or not windows.groups:
            continue
        places, begin = windows.indexable(numbers)
        if len(places):
            breaks = np.flatnonzero(np.diff(begin, prepend=-1))
            pieces.append(np.insert(numbers[places], breaks, 0))
            origin.append(np.insert(places, breaks, -1))
            owner.append(np.full(len(places) + len(breaks), at))
    if not pieces:
        return [h[:-1] > 0 for h in hits], names
    runs = np.append(np.concatenate(pieces), 0)
    origin, owner = np.concatenate(origin), np.concatenate(owner)
    index = FmIndex(runs, len(windows.vocabulary))
    for patterns, items in windows.groups:
        low, high = index.search(patterns)
        count = high - low
        which = np.repeat(np.arange(len(patterns)), count)
        rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - low, count)
        places = index.locate(rows)
        for w, place in zip(which.tolist(), places.tolist(), strict=True):
            doc, start = int(owner[place]), int(origin[place])
            hits[doc][start] += 1
            hits[doc][start + patterns.shape[1]] -= 1
            names[doc].update(items[w])
    return [np.cumsum(h[:-1]) > 0 for h in hits], names


def spans(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """Maximal runs of hit words: first word, and the word after."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
    return edge[::2].tolist(), edge[1::2].tolist()


@dataclass(frozen=True)
class Blocks:
    """The benchmark's items as a stored table, in blocks of a bounded number of words.

    Tasks read the blocks from the table, one at a time; a single block stays with its task.
    """

    path: str
    count: int

    def read(self, number: int) -> list[tuple[str, bytes]]:
        """The items of one block; it may have none."""
        files, base = place(f"{self.path}/block={number}")
        if files.get_file_info(base).type == fs.FileType.NotFound:
            return []
        rows = pq.read_table(base, filesystem=files, columns=["item", "text"], partitioning=None)
        return list(zip(rows.column("item").to_pylist(),
                        rows.column("text").cast(pa.binary()).to_pylist(), strict=True))

    def windows(self, window: int) -> Callable[[], Iterator[Windows]]:
        """Each call goes over all blocks, of which only one is held."""
        if self.count == 1:
            only = Windows(self.read(0), window)
            return lambda: iter([only])
        return lambda: (Windows(self.read(i), window) for i in range(self.count))


def stored_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Blocks:
    """Writes the items to the shared folder; each block has about ``block_words`` or one item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             F.col("text").cast("string").alias("text")).dropna()
    # Words are at least one byte and a separator apart.
    total = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    count = int(total // block_words) + 1
    path = new_scratch(benchmark.sparkSession, "benchmark")
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count)).cast("int")
    dealt = items.withColumn("block", block)
    # A part file per block, however many tasks there were.
    dealt.repartition(min(count, 200), "block").write.partitionBy("block").parquet(path)
    return Blocks(path, count)


def _shards(column: pa.Array) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Numbers and words of texts with words, a bounded number of words together."""
    shard: list[tuple[int, list[bytes]]] = []
    held = 0
    for i in range(len(column)):
        words = words_of(column[i].as_py() or b"")
        if words:
            shard.append((i, words))
            held += len(words)
        if held >= SHARD_WORDS:
            yield shard
            shard, held = [], 0
    if shard:
        yield shard


def _search(blocks: Callable[[], Iterator[Windows]], column: pa.Array) -> dict:
    """``n_words, begin, end, items`` of a batch of texts, indexed shard by shard.

    Every block searches all texts before the next one is read; hits add up by text.
    """
    n = len(column)
    sizes = [0] * n
    hits = [np.zeros(0, bool)] * n
    names: list[set[str]] = [set() for _ in range(n)]
    for at, block in enumerate(blocks()):
        for shard in _shards(column):
            flags, found = shard_hits(block, [block.numbers(w) for _, w in shard])
            for (i, words), hit, own in zip(shard, flags, found, strict=True):
                sizes[i] = len(words)
                hits[i] = hits[i] | hit if at else hit
                names[i] |= own
    edges = [spans(h) for h in hits]
    return {"n_words": sizes, "begin": [e[0] for e in edges], "end": [e[1] for e in edges],
            "items": [sorted(own) for own in names]}


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, begin, end, items`` with the merged spans of hit words."""
    table = stored_blocks(benchmark, block_words)

    def make():
        blocks = table.windows(window)

        def work(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column("doc_id"),
                    **_search(blocks, batch.column("text").cast(pa.binary()))}

        return work

    return map_batches(keyed(docs), make, "doc_id long, n_words long, begin array<int>, "
                       "end array<int>, items array<string>")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def without_words(data: bytes, begin: list[int], end: list[int]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in WORD.finditer(data.translate(TO_WORDS))]
    out, at = [], 0
    for a, b in zip(begin, end, strict=True):
        out.append(data[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, data[at:]])


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """All columns of the documents, with the hit spans cut out of ``text``."""
    table = stored_blocks(benchmark, block_words)

    def make():
        blocks = table.windows(window)

        def work(texts: pa.Array) -> pa.Array:
            column = texts.cast(pa.binary())
            found = _search(blocks, column)
            new = [t.as_py() if not a else without_words(t.as_py(), a, b)
                   for t, a, b in zip(column, found["begin"], found["end"], strict=True)]
            return pa.array(new, pa.binary()).cast(pa.string())

        return work

    return docs.withColumn("text", on_texts(make, "string")(F.col("text").cast("string")))
