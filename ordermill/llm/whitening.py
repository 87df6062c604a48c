"""Whitening of embeddings from an exact covariance by bit-sliced scatter.

Each entry becomes the whole number ``x = floor(1024 * c) + 100000``. Within a batch every dimension
is shifted by its smallest value, so that all numbers are at least 0, and is cut into bit planes:
plane p has bit p of every row, packed into 64-bit words across rows. The sum of products of two
dimensions is the sum over their planes of ``2 ** (p + q)`` times the number of common bits, an AND
and a population count. Shifts are undone in whole numbers, and batches add up in whole numbers of
any size, so order and retries do not matter. The covariance times the square of n is a matrix of
whole numbers, centred before anything is rounded; its eigenvectors are taken in double precision.

What reaches the driver are sums: one number per dimension and pair of dimensions, whatever the
number of rows is.

A row is dropped if its vector is null or holds null or non-finite entries. Likewise dropped are rows
whose entries do not fit ``LARGEST``, and rows whose length is not the most frequent one among the
others (the longer one at a tie), since they have no place in one covariance. Repeated rows, ids and
null ids count one by one. Components that explain nothing, as their eigenvalue is 0 but for rounding,
have null ``whitened`` values and 0 ``explained``, and there are at most as many components as
dimensions; ``identity_error`` looks at the others and is null if there is none. A ``deviation``
beyond a long is null. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.words import map_batches

SCALE = 1024
OFFSET = 100_000
#: Magnitude up to which ``floor(1024 * c)`` is taken; doubles hold such numbers exactly.
LARGEST = 2**50
COMPONENTS = 8
#: Rows that are cut into bit planes together.
BLOCK_ROWS = 8_192
WORD = 64
INT64 = 2**63

SUMS = "i int, j int, value decimal(38,0)"


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, vector`` as doubles, of rows whose entries are all there, finite and of a size."""
    vector = F.col(column).cast("array<double>")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= LARGEST))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
            .filter(F.col("vector").isNotNull() & ~bad))


def matrix(column: pa.Array) -> np.ndarray:
    """``floor(1024 * c)`` of a batch, a row per vector; all have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = len(column)
    return np.floor(flat * SCALE).astype(np.int64).reshape(rows, len(flat) // max(rows, 1))


def planes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of numbers from 0 on: their words, dimensions and bit numbers."""
    rows, dims = numbers.shape
    widths = [int(m).bit_length() for m in numbers.max(axis=0, initial=0)]
    dim = np.repeat(np.arange(dims), widths)
    bit = np.concatenate([np.zeros(0, np.int64), *[np.arange(w) for w in widths]])
    padded = np.zeros((dims, -(-rows // WORD) * WORD), np.int64)
    padded[:, :rows] = numbers.T
    words = np.empty((len(dim), padded.shape[1] // WORD), np.uint64)
    for i, (d, p) in enumerate(zip(dim.tolist(), bit.tolist(), strict=True)):
        words[i] = np.packbits(((padded[d] >> p) & 1).astype(np.uint8)).view(np.uint64)
    return words, dim, bit


def cross_products(numbers: np.ndarray) -> np.ndarray:
    """Exact sums of products of each two columns, as Python's whole numbers."""
    low = numbers.min(axis=0)
    shifted = numbers - low
    words, dim, bit = planes(shifted)
    dims = numbers.shape[1]
    common = np.zeros((len(dim), len(dim)), np.int64)
    for i in range(len(dim)):
        common[i, i:] = np.bitwise_count(words[i] & words[i:]).sum(axis=1, dtype=np.int64)
    common = np.maximum(common, common.T)
    # Plain integers where no sum can overflow.
    top = int(shifted.max(initial=0))
    kind = np.int64 if top * top * len(numbers) < INT64 else object
    weight = np.array([1 << p for p in bit.tolist()], kind)
    weighted = common.astype(kind) * weight[:, None] * weight
    squares = np.zeros((dims, dims), object)
    if len(dim):
        used, first = np.unique(dim, return_index=True)
        squares[np.ix_(used, used)] = np.add.reduceat(
            np.add.reduceat(weighted, first, axis=0), first, axis=1)
    sums = shifted.sum(axis=0).astype(object)
    low = low.astype(object)
    n = len(numbers)
    return squares + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a task's rows: at (-1, -1) the rows, at (-1, j) the sums, at (i, j) the products."""
    n, single, square = 0, 0, 0
    for batch in batches:
        numbers = matrix(batch.column("vector"))
        for begin in range(0, len(numbers), BLOCK_ROWS):
            part = numbers[begin:begin + BLOCK_ROWS]
            n += len(part)
            single = single + part.sum(axis=0).astype(object)
            square = square + cross_products(part)
    if n:
        dims = len(single)
        upper = [(i, j) for i in range(dims) for j in range(i, dims)]
        i = [-1] * (dims + 1) + [p[0] for p in upper]
        j = [-1, *range(dims)] + [p[1] for p in upper]
        value = [n, *single.tolist()] + [square[p] for p in upper]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
             pa.array(list(map(str, value))).cast(pa.decimal128(38, 0))], names=["i", "j", "value"])


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list and the components of its covariance.

    ``sums`` are those of ``floor(1024 * c)``, without the offset, which moves no deviation.
    """

    n: int
    dims: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def deviations(self, numbers: np.ndarray) -> list[int | None]:
        """``sum((n * x - S) ** 2)`` of each row, exact; None beyond a long."""
        top = max(map(abs, self.sums), default=0) + self.n * int(np.abs(numbers).max(initial=0))
        if top * top * max(self.dims, 1) < INT64:
            away = self.n * numbers - np.array(self.sums, np.int64)
            return (away * away).sum(axis=1).tolist()
        away = self.n * numbers.astype(object) - np.array(self.sums, object)
        exact = (away * away).sum(axis=1)
        return [v if v < INT64 else None for v in exact.tolist()]

    def whitened(self, numbers: np.ndarray) -> np.ndarray:
        """Centred rows on the components, over the root of their eigenvalues."""
        # The whole part of the mean leaves as a whole number, so no digit is lost.
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        centred = (numbers - whole) - rest
        return centred @ (self.vectors / np.sqrt(self.values))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vec_id, vector`` rows of one length; None without rows."""
    spark = vectors.sparkSession
    schema = spark.createDataFrame([], SUMS).schema
    found = vectors.mapInArrow(_sums, schema).groupBy("i", "j").agg(F.sum("value").alias("value"))
    # One number per pair of dimensions.
    held = {(r.i, r.j): int(r.value) for r in found.collect()}
    if not held:
        return None
    n = held.pop((-1, -1))
    sums = [held.pop((-1, j)) for j in range(sum(i == -1 for i, _ in held))]
    dims = len(sums)
    spread = np.zeros((dims, dims))
    for (i, j), product in held.items():
        # Centred as a whole number; only the quotient is rounded.
        spread[i, j] = spread[j, i] = (n * product - sums[i] * sums[j]) / (n * n)
    values, axes = np.linalg.eigh(spread) if dims else (np.zeros(0), spread)
    order = np.argsort(-values, kind="stable")[:components]
    values, axes = values[order], axes[:, order]
    trace = float(np.trace(spread))
    real = values > trace * dims * np.finfo(float).eps
    values, axes = values[real], axes[:, real]
    if len(values):
        # The largest entry of a component is positive.
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(values))])
    return Whitening(n, dims, tuple(sums), axes, values, trace)


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity.

    It is measured on the rows: their whitened values, centred by whole numbers already, are
    multiplied and summed per task.
    """
    size = len(model.values)
    if not size:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            rows = model.whitened(matrix(batch.column("vector")))
            total, square = total + rows.sum(axis=0), square + rows.T @ rows
        i, j = np.meshgrid(np.arange(-1, size), np.arange(size), indexing="ij")
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)),
             pa.array(np.vstack([total, square]).ravel())], names=["i", "j", "value"])

    sums = vectors.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(
        F.sum("value").alias("value")).collect()
    found = np.zeros((size + 1, size))
    for r in sums:
        found[r.i, r.j] = r.value  # -1 is the last row
    mean = found[-1] / model.n
    return float(np.abs(found[:-1] / model.n - np.outer(mean, mean) - np.eye(size)).max())


def one_length(vectors: DataFrame) -> DataFrame:
    """The rows of the most frequent length."""
    lengths = vectors.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return vectors.filter(F.size("vector") == F.lit(top.length if top else 0))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    One row per remaining vector and component, the components numbered from 1.
    """
    rows = one_length(usable(vectors))
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    model = fit(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    count = min(components, model.dims)
    share = np.zeros(count)
    if model.trace:
        share[:len(model.values)] = model.values / model.trace

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            numbers = matrix(batch.column("vector"))
            size = len(numbers)
            found = np.full((size, count), np.nan)
            found[:, :len(model.values)] = model.whitened(numbers)
            flat = found.ravel()
            picked = pa.array(np.repeat(np.arange(size), count))
            return {
                "vec_id": batch.column("vec_id").take(picked),
                "component": np.tile(np.arange(1, count + 1, dtype=np.int32), size),
                "n": np.full(len(flat), model.n),
                "deviation": pa.array(model.deviations(numbers), pa.int64()).take(picked),
                "whitened": pa.array(flat, mask=np.isnan(flat)),
                "explained": np.tile(share, size),
                "identity_error": pa.array([error] * len(flat), pa.float64())}

        return work

    return map_batches(rows, make, schema)
