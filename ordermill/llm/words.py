"""Words of a text as 64-bit hashes, and Arrow helpers that all operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.session import new_scratch

#: Bytes that separate words: the space and 0x09 to 0x0D. ``bytes.split()`` cuts at the same ones.
SPACES = b" \t\n\x0b\x0c\r"
IN_WORD = np.ones(256, bool)
IN_WORD[list(SPACES)] = False

#: Bytes of an Arrow batch that a function works on at a time.
SLICE_BYTES = 8_000_000

BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
FOLD = np.uint64(32)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    values = (values ^ (values >> FOLD)) * MIX
    values = (values ^ (values >> FOLD)) * MIX
    return values ^ (values >> FOLD)


def powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(max(n, 1), BASE, np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """One hash per word of UTF-8 text, in order; equal words have equal hashes."""
    codes = np.frombuffer(data, np.uint8)
    inside = IN_WORD[codes]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    lengths = edges[1::2] - edges[::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    begin = np.cumsum(lengths) - lengths
    letters = codes[inside].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(letters)) - np.repeat(begin, lengths)
    return mixed(np.add.reduceat(letters * powers(int(lengths.max()))[place], begin))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words, in order of their first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * BASE + words[i:i + n]
    return mixed(total)


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def map_batches(frame: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]],
                schema: str) -> DataFrame:
    """Applies ``make()``'s function to each Arrow batch; ``make`` runs once per task.

    The function returns one list or array for each column of ``schema``. It gets at most about
    ``SLICE_BYTES`` at a time, so that what it makes of a batch stays small; a row is never cut.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = frame.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            rows = batch.num_rows
            step = max(1, rows * SLICE_BYTES // max(batch.nbytes, SLICE_BYTES))
            for begin in range(0, rows, step):
                found = work(batch.slice(begin, step))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[f.name], f.type) for f in arrow], schema=arrow)

    return frame.mapInArrow(run, struct)


def on_texts(make: Callable[[], Callable[[pa.Array], pa.Array]], kind: str):
    """A function of a text column alone; all other columns stay where they are.

    ``make`` runs once per task; its function gets at most about ``SLICE_BYTES`` at a time.
    """
    @F.arrow_udf(kind)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for part in parts:
            step = max(1, len(part) * SLICE_BYTES // max(part.nbytes, SLICE_BYTES))
            found = [work(part.slice(b, step)) for b in range(0, max(len(part), 1), step)]
            yield pa.concat_arrays(found)

    return run


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, so that no later job computes it again."""
    spark: SparkSession = frame.sparkSession
    path = new_scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """Only the columns that operators on documents use."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps between its tasks."""
    held = sys.modules.setdefault("ordermill_worker", types.ModuleType("ordermill_worker"))
    if name not in held.__dict__:
        held.__dict__[name] = make()
    return held.__dict__[name]


class Coders:
    """Several number sequences of each word, looked up for many words at once.

    ``encode`` gives the sequences of words that were not seen before: for each kind of sequence all
    of them on end, and the length of each. Memory is bounded: beyond ``limit`` words, only those
    that were asked for again since the last time stay known, half of the limit at most.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[tuple[np.ndarray, np.ndarray]]],
                 limit: int, kinds: int):
        self.encode, self.limit = encode, limit
        self.index: dict[bytes, int] = {}
        self.held = [(np.zeros(0, np.uint32), np.zeros(0, np.int64)) for _ in range(kinds)]
        self.again = np.zeros(0, bool)

    def _forget(self) -> None:
        keep = np.flatnonzero(self.again)[-(self.limit // 2):]
        self.held = [(flat[_runs((np.cumsum(length) - length)[keep], length[keep])], length[keep])
                     for flat, length in self.held]
        known = list(self.index)  # in the order of their numbers
        self.index = {known[i]: n for n, i in enumerate(keep.tolist())}
        self.again = np.zeros(len(keep), bool)

    def _find(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def __call__(self, documents: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each kind all documents' numbers on end, and how many each document has."""
        sizes = np.array([len(d) for d in documents], np.int64)
        words = list(chain.from_iterable(documents))
        at = self._find(words)
        missing = np.flatnonzero(at < 0)
        self.again[at[at >= 0]] = True
        if len(missing):
            new = list({words[i] for i in missing.tolist()})
            if len(self.index) + len(new) > self.limit:
                self._forget()
                at = self._find(words)
                missing = np.flatnonzero(at < 0)
                new = list({words[i] for i in missing.tolist()})
            found = self.encode(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)),
                                  strict=True))
            self.held = [
                (np.concatenate([flat, more.astype(np.uint32)]), np.concatenate([length, sizes_]))
                for (flat, length), (more, sizes_) in zip(self.held, found, strict=True)]
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
            get = self.index.__getitem__
            at[missing] = np.fromiter((get(words[i]) for i in missing.tolist()), np.int64,
                                      len(missing))
        out = []
        for flat, length in self.held:
            start, own = np.cumsum(length) - length, length[at]
            ends = np.concatenate(([0], np.cumsum(own)))
            bounds = ends[np.concatenate(([0], np.cumsum(sizes)))]
            out.append((flat[_runs(start[at], own)], np.diff(bounds)))
        return out


class Coder:
    """One number sequence of each word; see :class:`Coders`."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 limit: int):
        self.coders = Coders(lambda words: [encode(words)], limit, 1)

    @property
    def index(self) -> dict[bytes, int]:
        return self.coders.index

    def __call__(self, documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        return self.coders(documents)[0]


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places from each start on, ``length`` of them, all on end."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - length), length) + np.arange(total)


def in_groups(documents: Iterable[list[bytes]], words: int = 400_000,
              ) -> Iterator[list[list[bytes]]]:
    """Consecutive documents with about so many words together."""
    group: list[list[bytes]] = []
    held = 0
    for document in documents:
        group.append(document)
        held += len(document)
        if held >= words:
            yield group
            group, held = [], 0
    if group:
        yield group
