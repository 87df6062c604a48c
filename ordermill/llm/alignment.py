"""Alignment of two tokenizers' tokens by lockstep merging.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces) the text, before
which it puts a space itself. Tokens are byte spans. A batch of documents has one vector of A
pointers and one of B pointers, an entry per document; a step takes each document's current pair of
tokens, which overlap, as a link, and moves the pointer whose token ends first, or both, which is a
cut. Documents that are finished leave the vectors. So a step costs a few NumPy calls whatever the
number of documents is. A long document is dealt over several entries, split where tokens of both
end together, so that the number of steps is bounded by the longest stretch without such a place.

Cuts divide a document into groups of A and B tokens of equal text. The count of an id pair is the
number of links of the whole corpus that hold it. Documents go through in chunks of bounded size;
a chunk stores its documents' distinct pairs and their numbers, pairs are summed over all chunks, and
the sums return to each chunk once per distinct pair, not per document or link.

A document takes part if its text is not null or empty and both tokenizers' bytes on end give the
space and the text; any other (with the mark of spaces in it, for example) has no tokens and zeros.
Repeated rows and ids count one by one, null ids are kept. A text of any length is one document and
alone in its chunk where it is longer than one. An empty table gives an empty result. Other columns
of the table are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import pieces
from ordermill.llm.bpe import JOINED, is_plain, parted, plain_words
from ordermill.llm.tokenfile import BYTE_LETTERS
from ordermill.llm.words import Coders, in_groups, keyed, map_batches, stored, texts, worker_state

KNOWN_WORDS = 400_000
KNOWN_CORES = 300_000
CHUNK_BYTES = 2_000_000
#: A document with more A tokens is dealt over entries of about so many.
ENTRY_TOKENS = 1_024
#: How far behind a wished place a common end of tokens is searched, in A tokens.
SEARCH = 64

ALIGNED = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
           "n_links array<long>, groups_sha256 array<string>, n_pairs array<int>, places binary, "
           "times binary, pair array<long>, total array<long>")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


def merged(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, a_to: np.ndarray,
           b_from: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links as indexes of A and B tokens, and for each whether both tokens end there.

    ``a_end`` and ``b_end`` are the tokens' ends, ascending. An entry has the A tokens from
    ``a_from`` to before ``a_to`` and the B tokens from ``b_from`` on; both begin and end together.
    """
    room = len(a_end) + len(b_end)
    link_a, link_b = np.empty(room, np.int32), np.empty(room, np.int32)
    is_cut = np.empty(room, bool)
    a, b, stop = a_from.copy(), b_from.copy(), a_to.copy()
    at = 0
    while len(a):
        to = at + len(a)
        link_a[at:to], link_b[at:to] = a, b
        gap = a_end[a] - b_end[b]
        is_cut[at:to] = gap == 0
        at = to
        a += gap <= 0
        b += gap >= 0
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return link_a[:at], link_b[:at], is_cut[:at]


def entries(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, a_to: np.ndarray,
            b_from: np.ndarray, size: int = ENTRY_TOKENS,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a_from, a_to, b_from`` after long documents are split where tokens of both end."""
    if not len(a_from):
        return a_from, a_to, b_from
    wished = np.concatenate([np.zeros(0, np.int64), *[
        np.arange(f + size, t - size // 2, size) for f, t in zip(a_from, a_to, strict=True)
        if t - f > size]])
    found_a, found_b = [], []
    for ahead in range(SEARCH):
        wished = wished[wished + ahead < a_to[-1] - 1]
        if not len(wished):
            break
        last = wished + ahead  # the last A token of an entry
        place = np.searchsorted(b_end, a_end[last])
        same = b_end[place] == a_end[last]
        found_a.append(last[same] + 1)
        found_b.append(place[same] + 1)
        wished = wished[~same]
    begin_a = np.concatenate([a_from, *found_a])
    begin_b = np.concatenate([b_from, *found_b])
    order = np.argsort(begin_a, kind="stable")
    begin_a, begin_b = begin_a[order], begin_b[order]
    fresh = np.concatenate([[True], np.diff(begin_a) > 0])
    begin_a, begin_b = begin_a[fresh], begin_b[fresh]
    return begin_a, np.append(begin_a[1:], a_to[-1]), begin_b


class Aligned:
    """The alignment of the documents of one chunk, all on end."""

    def __init__(self, aligner: Aligner, data: list[bytes]):
        a_ids, b_ids = aligner.ids(data)
        # A's bytes are the text's; B's have a space of one byte for each mark of three. So the
        # lengths tell whether the bytes are the same.
        fits = [s > 0 and aligner.a_length[a].sum() == s == aligner.pieces.length[b].sum()
                for s, a, b in zip((len(d) + 1 if d else 0 for d in data), a_ids, b_ids,
                                   strict=True)]
        none = np.zeros(0, np.int32)
        a_ids = [i if f else none for i, f in zip(a_ids, fits, strict=True)]
        b_ids = [i if f else none for i, f in zip(b_ids, fits, strict=True)]
        self.n_a = np.array([len(i) for i in a_ids], np.int64)
        self.n_b = np.array([len(i) for i in b_ids], np.int64)
        self.a = np.concatenate([none, *a_ids]).astype(np.int64)
        self.b = np.concatenate([none, *b_ids]).astype(np.int64)
        self.a_bound = np.concatenate([[0], np.cumsum(self.n_a)])
        self.b_bound = np.concatenate([[0], np.cumsum(self.n_b)])

        a_end = np.cumsum(aligner.a_length[self.a])
        b_end = np.cumsum(aligner.pieces.length[self.b])
        full = np.flatnonzero(self.n_a)
        split = entries(a_end, b_end, self.a_bound[full], self.a_bound[full + 1],
                        self.b_bound[full])
        self.link_a, self.link_b, is_cut = merged(a_end, b_end, *split)
        #: Whether a token is the last one of its group.
        self.a_last, self.b_last = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        self.a_last[self.link_a[is_cut]] = True
        self.b_last[self.link_b[is_cut]] = True
        self.doc_of_a = np.repeat(np.arange(len(data)), self.n_a)

    def per_document(self, of_a: np.ndarray) -> np.ndarray:
        """Sums of a value of each A token."""
        total = np.concatenate([[0], np.cumsum(of_a, dtype=np.int64)])
        return total[self.a_bound[1:]] - total[self.a_bound[:-1]]

    def digests(self, a_names: np.ndarray, b_names: np.ndarray) -> list[str]:
        """The checksum of each document's groups, ``a1,a2|b1;a3|b2``; '' without tokens.

        ``a_names`` has the spelling of each id followed by a comma, and then that of each id
        followed by a bar; ``b_names`` with a semicolon instead of the bar.
        """
        a_ends = np.flatnonzero(self.a_last) + 1  # A tokens up to each group's end
        b_ends = np.flatnonzero(self.b_last) + 1
        before = np.concatenate([[0], b_ends])
        out = np.empty(len(self.a) + len(self.b), object)
        group_a = np.cumsum(self.a_last) - self.a_last
        group_b = np.cumsum(self.b_last) - self.b_last
        out[np.arange(len(self.a)) + before[group_a]] = a_names[
            self.a + self.a_last * (len(a_names) // 2)]
        out[np.arange(len(self.b)) + a_ends[group_b]] = b_names[
            self.b + self.b_last * (len(b_names) // 2)]
        bounds = (self.a_bound + self.b_bound).tolist()
        names = out.tolist()
        return [hashlib.sha256(b"".join(names[f:t])[:-1]).hexdigest() if t > f else ""
                for f, t in zip(bounds[:-1], bounds[1:], strict=True)]

    def pair_numbers(self, b_size: int) -> tuple[np.ndarray, ...]:
        """Distinct id pairs, their numbers in the chunk, and per document how many, which and n.

        A pair is the A id times ``b_size`` plus the B id.
        """
        pair = self.a[self.link_a] * b_size + self.b[self.link_b]
        doc = self.doc_of_a[self.link_a]
        known = np.unique(pair)
        key = np.sort(doc * len(known) + np.searchsorted(known, pair))
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(first, append=len(key))
        key = key[first]
        place = key % max(len(known), 1)
        total = np.bincount(place, times, len(known)).astype(np.int64)
        n_pairs = np.bincount(key // max(len(known), 1), minlength=len(self.n_a))
        return known, total, n_pairs, place, times


class Aligner:
    """Both tokenizers, each distinct word encoded once while it is remembered."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(a_path)
        # Strings of special tokens in a text are plain text.
        self.tokenizer.encode_special_tokens = True
        letter_bytes = {c: b for b, c in BYTE_LETTERS.items()}
        letter_bytes |= {chr(b): b for b in range(256) if b not in BYTE_LETTERS}
        size = self.tokenizer.get_vocab_size()
        spelled = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        held = [bytes(letter_bytes[c] for c in s) if all(c in letter_bytes for c in s) else b""
                for s in spelled]
        self.a_length = np.array([len(h) for h in held], np.int64)
        self.pieces = pieces.coder(b_path)
        self.cores = Coders(self._cores, KNOWN_CORES, 2)
        self.words = Coders(self._words, KNOWN_WORDS, 2)
        #: Whether a line feed and the mark of spaces stand alone in B, as single spaces do.
        self.cuts = not self.pieces.line_feed
        self.b_size = len(self.pieces.length)
        self.a_names = self._names(size, b"|")
        self.b_names = self._names(self.b_size, b";")

    @staticmethod
    def _names(size: int, mark: bytes) -> np.ndarray:
        return np.array([b"%d%s" % (i, end) for end in (b",", mark) for i in range(size)], object)

    def _cores(self, cores: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of words, each without the space before it, or after ``JOINED``."""
        tokenize = self.tokenizer.model.tokenize
        a_found: list[list[int] | None] = []
        b_found: list[list[int]] = []
        for core in cores:
            text = core.decode() if core[:1] != JOINED else core[1:].decode()
            if core[:1] != JOINED and parted(text):
                # Letters after a space are one match to merge, which goes straight to the model.
                spelled = (b" " + core).decode("latin-1").translate(BYTE_LETTERS)
                a_found.append([t.id for t in tokenize(spelled)])
            else:
                a_found.append(None)
            b_found.append(self.pieces.ids_of(
                text if core[:1] == JOINED else pieces.SPACE + text))
        rest = [i for i, f in enumerate(a_found) if f is None]
        coded = self.tokenizer.encode_batch_fast(
            [(cores[i][1:] if cores[i][:1] == JOINED else b" " + cores[i]).decode() for i in rest],
            add_special_tokens=False)
        for i, own in zip(rest, coded, strict=True):
            a_found[i] = own.ids
        return [_on_end(a_found), _on_end(b_found)]

    def _words(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        found = [self.cores([self._ends(w) for w in words[begin:begin + 20_000]])
                 for begin in range(0, len(words), 20_000)]
        return [tuple(np.concatenate(parts) for parts in zip(*kind, strict=True))
                for kind in zip(*found, strict=True)]

    def _ends(self, word: bytes) -> list[bytes]:
        """A word without the marks at its end, and those, where no token of either has both."""
        found = parted(word.decode()) if word[:1] != JOINED else None
        if found and found[1] and found[0][-1] + found[1][0] not in self.pieces.inner:
            return [found[0].encode(), JOINED + found[1].encode()]
        return [word]

    def ids(self, data: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The A ids of each UTF-8 text with a space before it, and its B ids.

        An empty text has none. In a plain text no token of either goes on behind a space or over a
        line feed, so its words are looked up; any other text is encoded as a whole.
        """
        plain = [bool(d) and is_plain(d) and self.cuts for d in data]
        a_found: list[np.ndarray] = []
        b_found: list[np.ndarray] = []
        for group in in_groups(plain_words(d) for d, p in zip(data, plain, strict=True) if p):
            for out, (ids, sizes) in zip((a_found, b_found), self.words(group), strict=True):
                out += np.split(ids, np.cumsum(sizes)[:-1])
        a_known, b_known = iter(a_found), iter(b_found)
        none = np.zeros(0, np.uint32)
        a_out, b_out = [], []
        for d, p in zip(data, plain, strict=True):
            if p:
                a_out.append(next(a_known))
                b_out.append(next(b_known))
            elif d:
                a_out.append(np.array(self.tokenizer.encode(
                    " " + d.decode(), add_special_tokens=False).ids, np.uint32))
                b_out.append(self.pieces.encode([d])[0])
            else:
                a_out.append(none)
                b_out.append(none)
        return a_out, b_out


def _on_end(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(f) for f in found], np.int64)
    return np.fromiter(chain.from_iterable(found), np.uint32, int(length.sum())), length


def coder(a_path: str, b_path: str) -> Aligner:
    """The worker's own pair of tokenizers."""
    return worker_state(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path))


def chunks(data: list[bytes], size: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts of about ``size`` bytes together."""
    begin = held = 0
    for i, text in enumerate(data):
        if held and held + len(text) > size:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(data):
        yield begin, len(data)


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_cuts, b_cuts, link_a, link_b`` of each document.

    Cuts are the numbers of A and B tokens up to the end of each group; links are the places of two
    overlapping tokens in ``a_ids`` and ``b_ids``, in text order.
    """
    names = ("a_ids", "b_ids", "a_cuts", "b_cuts", "link_a", "link_b")

    def make():
        aligner = coder(a_path, b_path)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n in names}
            data = texts(batch.column("text"))
            for begin, end in chunks(data, CHUNK_BYTES):
                found = Aligned(aligner, data[begin:end])
                order = np.lexsort((found.link_b, found.link_a))
                link_a, link_b = found.link_a[order], found.link_b[order]
                link_bound = np.searchsorted(link_a, found.a_bound)
                for i in range(end - begin):
                    a0, a1 = found.a_bound[i:i + 2]
                    b0, b1 = found.b_bound[i:i + 2]
                    links = slice(*link_bound[i:i + 2])
                    for name, value in zip(names, (
                            found.a[a0:a1], found.b[b0:b1],
                            np.flatnonzero(found.a_last[a0:a1]) + 1,
                            np.flatnonzero(found.b_last[b0:b1]) + 1,
                            link_a[links] - a0, link_b[links] - b0), strict=True):
                        out[name].append(value.astype(np.int32))
            return {"doc_id": batch.column("doc_id"), **out}

        return work

    return map_batches(keyed(docs), make, "doc_id long, " + ", ".join(
        f"{n} array<int>" for n in names))


def aligned_chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per chunk: its documents' numbers, their distinct pairs, and the chunk's pairs."""
    def make():
        aligner = coder(a_path, b_path)
        task = TaskContext.get()
        state = {"chunk": (task.partitionId() if task else 0) << 33}

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c.split()[0]: [] for c in ALIGNED.split(", ")}
            data = texts(batch.column("text"))
            names = batch.column("doc_id").to_pylist()
            pack = zstandard.ZstdCompressor(level=1).compress
            for begin, end in chunks(data, CHUNK_BYTES):
                found = Aligned(aligner, data[begin:end])
                known, total, n_pairs, place, times = found.pair_numbers(aligner.b_size)
                values = {
                    "chunk": state["chunk"], "doc_id": names[begin:end],
                    "n_a": found.n_a, "n_b": found.n_b,
                    "n_groups": found.per_document(found.a_last),
                    "n_links": np.bincount(found.doc_of_a[found.link_a], minlength=end - begin),
                    "groups_sha256": found.digests(aligner.a_names, aligner.b_names),
                    "n_pairs": n_pairs,
                    # Places ascend within a document, so their differences are small.
                    "places": pack(np.diff(place, prepend=0).astype("<i4").tobytes()),
                    "times": pack(times.astype("<u4").tobytes()), "pair": known, "total": total}
                state["chunk"] += 1
                for name, value in values.items():
                    out[name].append(value)
            return out

        return work

    return map_batches(keyed(docs), make, ALIGNED)


def _scored(arrow: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Makes the rows of the result from chunks with the corpus counts of their pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].values for n in (
                    "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs")}
                scores = batch.column("scores")[at].values
                size = 0 if scores is None else len(scores)
                count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
                if size:
                    known = scores.field("place").to_numpy()
                    count[known] = scores.field("count").to_numpy()
                    best[known] = scores.field("best").to_numpy()
                steps = np.frombuffer(unpack(batch.column("places")[at].as_py()), "<i4")
                place = np.cumsum(steps, dtype=np.int64)
                times = np.frombuffer(unpack(batch.column("times")[at].as_py()), "<u4")
                bound = np.concatenate([[0], np.cumsum(row.pop("n_pairs").to_numpy())])
                for name, value in (("count_sum", count), ("n_best", best)):
                    total = np.concatenate([[0], np.cumsum(times.astype(np.int64) * value[place])])
                    row[name] = pa.array(total[bound[1:]] - total[bound[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [row[f.name].cast(f.type) for f in arrow], schema=arrow)

    return run


def alignment_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document its tokens, groups, links, and how its links stand in the whole corpus.

    ``n_best`` counts links whose pair is the most frequent one of its B id, ties included;
    ``count_sum`` adds up the corpus counts of all links.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    result = docs.sparkSession.createDataFrame([], RESULT).schema
    aligned = stored(aligned_chunks(docs, a_path, b_path), "aligned")
    b_size = F.lit(pieces.piece_count(b_path))
    pairs = aligned.select("chunk", F.posexplode(F.arrays_zip("pair", "total"))).select(
        "chunk", F.col("pos").alias("place"), "col.pair", "col.total")
    counts = stored(pairs.groupBy("pair").agg(F.sum("total").alias("count")), "pair-counts")
    tops = counts.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("count").alias("top"))
    # At most one row per id of B.
    scored = counts.withColumn("b", F.col("pair") % b_size).join(F.broadcast(tops), "b").select(
        "pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))
    # A chunk has at most one score per distinct pair of its bounded text.
    scores = pairs.drop("total").join(scored, "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("place", "count", "best")).alias("scores"))
    return (aligned.drop("pair", "total").join(scores, "chunk", "left")
            .mapInArrow(_scored(to_arrow_schema(result)), result))
