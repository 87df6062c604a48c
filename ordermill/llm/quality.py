"""Quality rules: counts per text, and a classifier trained on labelled rows.

The classifier is a logistic regression over hashed frequencies of byte trigrams, words and word
pairs. It is fitted on at most ``TRAINING_ROWS`` labelled documents, chosen by a hash of their id
and half of them of either quality where there are enough, calibrated on the held-out quarter and
set back to the share of good labels in the whole label table. All documents are scored, in Arrow
batches, against a fixed threshold.

Nulls: a null text is empty and has no words; it fails the base rules. Labels without a quality,
document or with one quality only are no training set; then the base rules alone decide. Repeated
rows are judged alike, one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.words import (
    SPACES, gram_hashes, keyed, map_batches, on_texts, texts, word_hashes,
)

TRAINING_ROWS = 1_500
KEEP_AT = 0.5
BUCKETS = 2_048
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean")


@dataclass(frozen=True)
class Model:
    """``weights`` has one block of ``BUCKETS`` for each kind of feature, then the intercept."""

    weights: np.ndarray
    slope: float
    shift: float

    def chance(self, row: np.ndarray) -> float:
        """The probability that a text is good."""
        raw = float(row @ self.weights[:-1] + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -50, 50))))


def counts(data: bytes, code_points: int, words: np.ndarray) -> tuple:
    """The base counts of one text."""
    n = len(words)
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    covered = 0
    if n >= 3:
        _, group, size = np.unique(gram_hashes(words, 3), return_inverse=True, return_counts=True)
        again = np.flatnonzero(size[group] > 1)
        hit = np.zeros(n + 2, bool)
        for i in range(3):
            hit[again + i] = True
        covered = int(hit.sum())
    failed = n < MIN_WORDS or 100 * covered > MAX_REPEAT_PERCENT * n
    return (n, code_points - spaces, symbols, len(lines) - len(set(lines)), covered, failed)


def features(data: bytes, words: np.ndarray) -> np.ndarray:
    """Square roots of hashed frequencies: byte trigrams, words, word pairs."""
    codes = np.frombuffer(data, np.uint8).astype(np.uint32)
    grams = (codes[:-2] * 40_503 + codes[1:-1] * 10_007 + codes[2:] * 977) >> np.uint32(5)
    blocks = (grams, words, gram_hashes(words, 2))
    return np.concatenate([
        np.sqrt(np.bincount((b & b.dtype.type(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                / max(len(b), 1)) for b in blocks]).astype(np.float32)


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression with balanced classes, by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    part = np.where(y, 0.5 / max(y.sum(), 1), 0.5 / max((~y).sum(), 1)).astype(np.float32)
    weights = ahead = np.zeros(x.shape[1], np.float32)
    for step in range(steps):
        error = part * (1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30))) - y)
        new = ahead - (x.T @ error + decay * ahead)
        ahead = new + step / (step + 3) * (new - weights)
        weights = new
    return weights


def _calibrate(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log odds (Platt), with smoothed targets."""
    good, bad = y.sum(), (~y).sum()
    target = np.where(y, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        s = p * (1 - p) + 1e-9
        g = np.array([((p - target) * raw).sum(), (p - target).sum()])
        h = np.array([[(s * raw * raw).sum() + 1e-6, (s * raw).sum()],
                      [(s * raw).sum(), s.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - float(np.clip(move[0], -2, 2)), b - float(np.clip(move[1], -2, 2))
    return a, b


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS) -> Model | None:
    """The classifier, or None where the labels have no two qualities."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
              .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)))
    shares = {r.quality: r.n for r in marked.groupBy("quality").agg(F.count("*").alias("n"))
              .collect()}
    if len(shares) < 2:
        return None
    order = F.xxhash64("doc_id")
    half = [marked.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(max_rows // 2)
            for q in (0, 1)]

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            rows = [features(t, word_hashes(t)).astype(np.float16).tobytes()
                    for t in texts(batch.column("text"))]
            return {"doc_id": batch.column("doc_id"), "quality": batch.column("quality"),
                    "row": rows}

        return work

    # The sample has at most max_rows rows.
    sample = half[0].union(half[1]).withColumn("quality", F.col("quality").cast("int"))
    known = keyed(docs).join(F.broadcast(sample), "doc_id")
    rows = sorted(map_batches(known, make, "doc_id long, quality int, row binary").collect())
    y = np.array([r.quality == 1 for r in rows], bool)
    if not 0 < y.sum() < len(y):
        return None
    x = np.frombuffer(b"".join(r.row for r in rows), np.float16).reshape(len(rows), -1)
    x = x.astype(np.float32)
    held = np.arange(len(y)) % 4 == 3
    if any(not 0 < y[part].sum() < part.sum() for part in (held, ~held)):
        held = np.zeros(len(y), bool)
    weights = _fit(x[~held], y[~held])
    raw = x @ weights[:-1] + weights[-1]
    slope, shift = _calibrate(raw[held], y[held]) if held.any() else (1.0, 0.0)
    prior = np.log(shares[1] / shares[0]) - np.log(y.sum() / (~y).sum())
    return Model(weights, slope, float(shift + prior))


def _verdict(model: Model | None, keep_at: float, data: bytes, code_points: int) -> tuple:
    words = word_hashes(data)
    own = counts(data, code_points, words)
    good = 1.0 if model is None else model.chance(features(data, words))
    return (*own, good, not own[-1] and good >= keep_at)


def judge(docs: DataFrame, model: Model | None, keep_at: float = KEEP_AT) -> DataFrame:
    """Base counts, the probability of being good and the verdict, one row per document."""
    names = [c.split()[0] for c in COUNTS.split(", ")] + ["p_good", "kept"]

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            column = batch.column("text")
            points = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
            found = [_verdict(model, keep_at, *row)
                     for row in zip(texts(column), points, strict=True)]
            return {"doc_id": batch.column("doc_id"),
                    **{n: list(c) for n, c in zip(names, zip(*found, strict=True), strict=True)}}

        return work

    return map_batches(keyed(docs), make, f"doc_id long, {COUNTS}, p_good double, kept boolean")


def accepted(docs: DataFrame, model: Model | None, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents that pass, with all their columns; only texts leave the JVM."""
    def make():
        def work(column: pa.Array) -> pa.Array:
            points = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
            return pa.array([_verdict(model, keep_at, *pair)[-1]
                             for pair in zip(texts(column), points, strict=True)], pa.bool_())

        return work

    return docs.filter(on_texts(make, "boolean")(F.col("text").cast("string")))
