"""Byte-level BPE with DuckDB in each partition.

A text is cut into the matches of the split pattern. The bytes of distinct matches become rows of piece,
place and token; a recursive query joins each row and its right neighbour with the merge table and
contracts, in every piece at once, the leftmost pair of smallest rank, until no piece has a pair in
the table. Matches that are tokens themselves need no merge. Ids are put
together per text; decoding joins ids with the vocabulary and aggregates its bytes in order.

A worker keeps the ids of pieces and of the words between two spaces for later texts, up to a fixed
number, so the queries see each distinct piece about once.

Each round of the recursive query leaves a row per open token, so a piece of n bytes costs about
n * n / 2 rows. A batch of pieces is bounded by these rows; a piece of more than ``LONG_PIECE``
bytes is merged outside the query, by a heap of its pairs. Decoding sends ``DECODE_TOKENS`` ids at
a time, whatever text they belong to.

Nulls: a null text is empty and has no ids. Repeated rows are encoded one by one. A text of any
length is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ordermill.llm.words import Coder, in_groups, keyed, map_batches, texts, worker_state

#: Fixed value: the characters that ``\\s`` stands for in the split pattern.
SPACE = r"\t-\r \x85\xa0  -     　"
DECODE_TOKENS = 150_000
MERGE_PIECES = 20_000
MERGE_ROWS = 2_000_000
LONG_PIECE = 512
KNOWN_PIECES = 400_000
KNOWN_WORDS = 250_000

# A row's spot is its piece times 2^32 and its place, so one order serves all pieces.
ENCODE = """
WITH RECURSIVE step(spot, token, open) AS (
    SELECT spot, token, true FROM start
  UNION ALL (
    WITH pairs AS MATERIALIZED (
        SELECT s.spot, s.token, s.before, m.merged
        FROM (
            SELECT spot, token, lag(spot) OVER w AS before, lead(spot) OVER w AS after,
                   (token::BIGINT << 32) + lead(token) OVER w AS pair
            FROM step WHERE open
            WINDOW w AS (ORDER BY spot)
        ) s
        LEFT JOIN merges m ON m.pair = s.pair AND s.after >> 32 = s.spot >> 32
    ),
    firsts AS (
        SELECT spot >> 32 AS piece, min((merged::BIGINT << 32) + (spot & 4294967295)) AS best
        FROM pairs GROUP BY 1
    )
    SELECT spot,
           CASE WHEN spot & 4294967295 = best & 4294967295 THEN (best >> 32)::INT ELSE token END,
           best IS NOT NULL
    FROM pairs JOIN firsts ON firsts.piece = pairs.spot >> 32
    WHERE best IS NULL OR before IS NULL OR before <> (piece << 32) + (best & 4294967295)
  )
)
SELECT (spot >> 32)::INT AS piece, token FROM step WHERE NOT open ORDER BY spot
"""

DECODE = """
SELECT doc, unhex(string_agg(v.bytes, '' ORDER BY t.place)) AS text
FROM tokens t JOIN vocabulary v ON v.token = t.token
GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern with its spaces spelled out."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]")
                         .replace(r"\s", f"[{SPACE}]"))


#: UTF-8 of every character that the pattern takes for space, and other control characters.
BLANK = (rb"(?:[\x00-\x20\x7f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"
         rb"|\xe2\x81\x9f|\xe3\x80\x80)")
BLANK_FIRST = re.compile(BLANK)
BLANK_LAST = re.compile(BLANK + rb"\Z")
#: The blanks of several bytes, which no ASCII text has.
WIDE_BLANK = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"
                        rb"|\xe2\x81\x9f|\xe3\x80\x80")
CONTROLS = bytes([*range(10), *range(11, 32), 127])
#: Stands before a word that has no space before it; no UTF-8 text has this byte.
JOINED = b"\xff"
#: Letters before this one take two bytes at most.
LATIN_END = "\u0250"
#: Marks that are one match of the pattern after a letter. The apostrophe is none.
MARKS = ".,;:!?$#*%&|<>()\"-=_/"


def is_plain(data: bytes) -> bool:
    """Whether all blanks are single spaces and line feeds between other characters."""
    return (b"  " not in data and b" \n" not in data and b"\n " not in data and b"\n\n" not in data
            and data[:1] not in (b" ", b"\n") and data[-1:] not in (b" ", b"\n")
            and len(data.translate(None, CONTROLS)) == len(data)
            and (data.isascii() or not WIDE_BLANK.search(data)))


def plain_words(data: bytes) -> list[bytes]:
    """The words of a plain text and its line feeds, which no match of the pattern joins.

    A word stands for a space and itself, one after ``JOINED`` for itself; the first one for a
    space, too.
    """
    return data.replace(b"\n", b" " + JOINED + b"\n " + JOINED).split(b" ")


def parted(word: str) -> tuple[str, str] | None:
    """Latin letters and the marks after them, which are two matches of the pattern."""
    core = word.rstrip(MARKS)
    return (core, word[len(core):]) if core.isalpha() and max(core) < LATIN_END else None


class Bpe:
    """Encodes and decodes with one vocabulary; ids are ranks."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = split_pattern(pattern)
        self.pieces = Coder(self._merge, KNOWN_PIECES)
        self.words = Coder(self._cut, KNOWN_WORDS)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB",
                                         "temp_directory": "", "preserve_insertion_order": False})
        merges = [((self.ranks[t[:i]] << 32) + self.ranks[t[i:]], r) for t, r in self.ranks.items()
                  for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self._table("merges", {"pair": [m[0] for m in merges], "merged": [m[1] for m in merges]})
        self._table("vocabulary", {"token": list(self.ranks.values()),
                                   "bytes": [t.hex() for t in self.ranks]})

    def _table(self, name: str, columns: dict) -> None:
        rows = pa.table(columns)  # noqa: F841  read by the query
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM rows")

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces by the recursive query; a piece that is a token starts as this token."""
        flat, length = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for part in self._batches(pieces):
            if len(part[0]) > LONG_PIECE and part[0] not in self.ranks:
                flat.append(self._merge_long(part[0]))
                length.append(np.array([len(flat[-1])], np.int64))
                continue
            known = np.array([self.ranks.get(p, -1) for p in part], np.int32)
            sizes = np.array([len(p) for p in part], np.int64)
            owner = np.repeat(np.arange(len(part)), sizes)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            token = self.single[np.frombuffer(b"".join(part), np.uint8)]
            whole = known[owner] >= 0
            token = np.where(whole, known[owner], token)
            keep = ~whole | (place == 0)
            self._table("start", {"spot": (owner[keep] << 32) + place[keep],
                                  "token": token[keep]})
            rows = self.db.execute(ENCODE).fetchnumpy()
            flat.append(np.asarray(rows["token"]))
            length.append(np.bincount(np.asarray(rows["piece"]), minlength=len(part)))
        return np.concatenate(flat), np.concatenate(length)

    def _batches(self, pieces: list[bytes]) -> Iterator[list[bytes]]:
        """Consecutive pieces of bounded number and rows; a long piece is alone."""
        part: list[bytes] = []
        rows = 0
        for piece in pieces:
            own = 1 if piece in self.ranks else len(piece) * (len(piece) + 1) // 2
            alone = len(piece) > LONG_PIECE and piece not in self.ranks
            if part and (alone or len(part) >= MERGE_PIECES or rows + own > MERGE_ROWS):
                yield part
                part, rows = [], 0
            part.append(piece)
            rows += own
            if alone:
                yield part
                part, rows = [], 0
        if part:
            yield part

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one piece: the leftmost pair of smallest rank is contracted until none is left."""
        n, get = len(piece), self.ranks.get
        after, before = array("i", range(1, n + 2)), array("i", range(-1, n))
        token = array("i", self.single[np.frombuffer(piece, np.uint8)].tolist())
        # A pair is its rank and its place in one number; a pair that is gone has another rank.
        heap = [(rank << 32) + i for i in range(n - 1)
                if (rank := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            best = heapq.heappop(heap)
            rank, i = best >> 32, best & 0xFFFFFFFF
            j = after[i]
            if token[i] < 0 or j >= n or get(piece[i:after[j]]) != rank:
                continue
            token[i], token[j] = rank, -1
            after[i] = end = after[j]
            if end < n:
                before[end] = i
                if (rank := get(piece[i:after[end]])) is not None:
                    heapq.heappush(heap, (rank << 32) + i)
            if i and (rank := get(piece[before[i]:end])) is not None:
                heapq.heappush(heap, (rank << 32) + before[i])
        found = np.array(token, np.int32)
        return found[found >= 0]

    def _cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each the text of one or more whole pieces; see :meth:`cut`."""
        flat, length = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for begin in range(0, len(words), MERGE_PIECES):
            ids, sizes = self.pieces([self._pieces_of(w) for w in words[begin:begin + MERGE_PIECES]])
            flat.append(ids)
            length.append(sizes)
        return np.concatenate(flat), np.concatenate(length)

    def _pieces_of(self, word: bytes) -> list[bytes]:
        """The matches of the pattern in a word; plain letters and marks behind need no search."""
        if word.isalpha():
            return [b" " + word]
        space = word[:1] not in (b" ", JOINED)
        text = (word if space else word[1:]).decode()
        found = parted(text)
        if found:
            core = (b" " if space else b"") + found[0].encode()
            return [core, found[1].encode()] if found[1] else [core]
        return [p.encode() for p in self.pattern.findall(" " * space + text)]

    @staticmethod
    def cut(data: bytes) -> list[bytes]:
        """The text in words at single spaces between other characters.

        No match of the pattern crosses such a place, as a space goes with what follows it. Words
        with other space at an edge stay together with their neighbour. A word after its space is
        given without it; any other is marked by a space or by ``JOINED`` in front. In plain texts
        line feeds are words, too.
        """
        if data and is_plain(data):
            parts = plain_words(data)
            parts[0] = JOINED + parts[0]
            return parts
        parts = data.split(b" ")
        out, held = [], parts[0]
        open_end = bool(held) and not BLANK_LAST.search(held)
        for part in parts[1:]:
            if open_end and part and not BLANK_FIRST.match(part):
                out.append(held)
                held = b" " + part
            else:
                held += b" " + part
            open_end = bool(part) and not BLANK_LAST.search(part)
        if held:
            out.append(held)
        return [w[1:] if w[:1] == b" " and w[1:2] not in (b"", b" ") else b" " + w for w in out]

    def encode(self, data: list[bytes]) -> list[np.ndarray]:
        """The ids of each UTF-8 text."""
        out: list[np.ndarray] = []
        for group in in_groups(map(self.cut, data), 100_000):
            ids, sizes = self.words(group)
            out += np.split(ids, np.cumsum(sizes)[:-1])
        return out

    def decoded_parts(self, documents: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        """The bytes of each id sequence in order, as its number and one part after the other."""
        ends = np.cumsum([len(d) for d in documents], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *documents])
        for begin in range(0, len(flat), DECODE_TOKENS):
            place = np.arange(begin, min(begin + DECODE_TOKENS, len(flat)))
            self._table("tokens", {"doc": np.searchsorted(ends, place, "right"), "place": place,
                                   "token": flat[place].astype(np.int64)})
            yield from self.db.execute(DECODE).fetchall()

    def decode(self, documents: list[np.ndarray]) -> list[bytes]:
        """The bytes of each id sequence."""
        found: list[list[bytes]] = [[] for _ in documents]
        for doc, part in self.decoded_parts(documents):
            found[doc].append(part)
        return [b"".join(parts) for parts in found]

    def decoded_sha256(self, documents: list[np.ndarray]) -> list[str]:
        """The checksum of the bytes of each id sequence."""
        found = [hashlib.sha256() for _ in documents]
        for doc, part in self.decoded_parts(documents):
            found[doc].update(part)
        return [f.hexdigest() for f in found]


def coder(path: str, pattern: str) -> Bpe:
    """The worker's own coder for a vocabulary."""
    return worker_state(f"bpe {path} {pattern}", lambda: Bpe(path, pattern))


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of each document."""
    def make():
        bpe = coder(path, pattern)

        def work(batch: pa.RecordBatch) -> dict:
            ids = bpe.encode(texts(batch.column("text")))
            return {"doc_id": batch.column("doc_id"), "ids": [i.astype(np.int32) for i in ids]}

        return work

    return map_batches(keyed(docs), make, "doc_id long, ids array<int>")


def round_trips(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, and decoded from the ids."""
    def make():
        bpe = coder(path, pattern)

        def work(batch: pa.RecordBatch) -> dict:
            ids = bpe.encode(texts(batch.column("text")))
            return {
                "doc_id": batch.column("doc_id"), "n_tokens": [len(i) for i in ids],
                "ids_sha256": [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                "decoded_sha256": bpe.decoded_sha256(ids)}

        return work

    return map_batches(keyed(docs), make, "doc_id long, n_tokens long, ids_sha256 string, "
                       "decoded_sha256 string")
