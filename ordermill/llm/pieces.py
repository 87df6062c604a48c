"""SentencePiece BPE by the last piece of each prefix.

A model of kind BPE starts from characters and joins, again and again, the two neighbours whose text
is the best piece, the leftmost at a tie. What it makes of a text follows from pairs alone: pieces in a
row are the result exactly if each two neighbours are the result for their own text. So each prefix
has one last piece, and a piece that ends a longer prefix is the last one if it goes with the last
piece of what stands before it. An automaton gives the pieces that end at each character; the table
of last pieces is filled from left to right, one entry per character, and the ids are recovered from
it backwards.

Two pieces go together if no merge crosses their border. Of the left one only the chain of right
parts touches the border, of the right one only the chain of left parts. The chains are undone from
the latest merge on; a pair of parts that would have been merged before the next merge of a chain
breaks the border. That asks that a piece ranks behind its parts; the few that do not (runs of
spaces) are tested by running the merges of their text.

Characters without a piece, such as a line feed, end a run and become byte pieces. No piece has a
space after another character, and none has letters before punctuation. So words between spaces or
line feeds are independent, and so is the punctuation at their ends. A worker keeps the ids of what
it has seen, up to a fixed number. A text of any length is encoded whole, and each of its words in
time linear in its length.

Nulls: a null text is empty and has only the begin and end ids. Repeated rows are encoded one by
one. An empty table gives an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from ordermill.llm.words import Coder, in_groups, keyed, map_batches, texts, worker_state

#: Fixed value: the character that stands for a space in pieces.
SPACE = "▁"
KNOWN_WORDS = 400_000
KNOWN_CORES = 400_000
KNOWN_PAIRS = 1_000_000
GROUP_WORDS = 200_000
ID_BITS = 24
MARKS = ".,;:!?$#*%&|<>()\"'-=_/"


class Pieces:
    """Encodes and decodes with one model of kind BPE without normalization."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                   for i in range(len(names))]
        self.id_of = {p: i for i, p in enumerate(names) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("pieces that go on after a space are not supported")
        if any(c not in self.id_of for p in self.id_of for c in p):
            raise ValueError("pieces with characters that are no pieces are not supported")
        if model.get_piece_size() > 1 << ID_BITS:
            raise ValueError("the model has too many pieces")
        self.names = names
        self.inner = {p[i:i + 2] for p in self.id_of for i in range(len(p) - 1)}
        self.line_feed = "\n" in self.id_of
        self.rank = {p: -model.get_score(i) for p, i in self.id_of.items()}
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        self.bos, self.eos = model.bos_id(), model.eos_id()

        self.parts: dict[str, tuple[str, str]] = {}
        self.plain: dict[str, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(self.id_of, key=len):
            found, parts = self._merged(piece)
            if len(found) != 1:
                continue  # no text is ever joined to this piece
            if parts:
                self.parts[piece] = parts
            self.plain[piece] = not parts or all(
                self.plain.get(p, True) and (len(p) == 1 or self.rank[p] < self.rank[piece])
                for p in parts)
            self.automaton.add_word(piece, (self.id_of[piece], len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.cores = Coder(self._cores, KNOWN_CORES)
        self.words = Coder(self._words, KNOWN_WORDS)

        # The bytes of each id, with a space for its mark; control ids have none.
        held = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        for b, i in enumerate(self.byte_id.tolist()):
            held[i] = bytes([b])
        self.length = np.array([len(h) for h in held], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(held), np.uint8)

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """What the merges make of a short text, and the two parts that the last one joined."""
        found, parts = list(text), None
        while True:
            best = min(((rank, i) for i in range(len(found) - 1)
                        if (rank := self.rank.get(found[i] + found[i + 1])) is not None),
                       default=None)
            if best is None:
                return found, parts
            i = best[1]
            parts = found[i], found[i + 1]
            found[i:i + 2] = [found[i] + found[i + 1]]

    def _tested(self, pair: int) -> bool:
        """Whether two pieces go together, given as the left id and the right one in one number."""
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        left, right = self.names[pair >> ID_BITS], self.names[pair & ((1 << ID_BITS) - 1)]
        found = self.pairs[pair] = self.goes_with(left, right)
        return found

    def goes_with(self, left: str, right: str) -> bool:
        """Whether no merge crosses the border of two pieces."""
        if not (self.plain[left] and self.plain[right]):
            return self._merged(left + right)[0] == [left, right]
        rank, parts = self.rank, self.parts
        # The rank of the merge that ends the time of the part at the border, if one does.
        left_end = right_end = None
        while True:
            joined = rank.get(left + right)
            if joined is not None and (left_end is None or joined < left_end) and (
                    right_end is None or joined <= right_end):
                return False
            undo_left = rank[left] if left in parts else None
            undo_right = rank[right] if right in parts else None
            if undo_left is None and undo_right is None:
                return True
            # The later merge goes first; at a tie that is the right one.
            if undo_right is None or (undo_left is not None and undo_left > undo_right):
                left_end, left = undo_left, parts[left][1]
            else:
                right_end, right = undo_right, parts[right][0]

    def prefix_table(self, text: str) -> list[int]:
        """The last piece of each prefix of a text, by the prefix's length.

        -1 stands for a character without a piece, and for the empty prefix.
        """
        last = [-1] * (len(text) + 1)
        known = self.pairs.get
        for end, (piece, length) in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                left = last[end - length]
                # At the start and behind a character without a piece there is no pair to test.
                if left >= 0:
                    pair = left << ID_BITS | piece
                    fits = known(pair)
                    if not (self._tested(pair) if fits is None else fits):
                        continue
                last[end] = piece
        return last

    def ids_of(self, text: str) -> list[int]:
        """The ids of a text in which spaces are marks, from the end of its prefix table."""
        last, names = self.prefix_table(text), self.names
        found: list[int] = []
        at = len(text)
        while at:
            piece = last[at]
            if piece < 0:
                at -= 1
                found += [int(self.byte_id[b]) for b in reversed(text[at].encode())]
            else:
                found.append(piece)
                at -= len(names[piece])
        found.reverse()
        return found

    def _cores(self, cores: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.ids_of(c.decode()) for c in cores]
        length = np.array([len(f) for f in found], np.int64)
        return np.fromiter((i for f in found for i in f), np.uint32, int(length.sum())), length

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.cores([self._cores_of(w.decode()) for w in words])

    def _cores_of(self, word: str) -> list[bytes]:
        """A word of :meth:`cut` with its spaces as marks, its punctuation at the end apart."""
        text = word.replace(" ", SPACE)
        if "\n" not in word or self.line_feed:
            text = SPACE + text
        else:
            head, feed, text = text.rpartition("\n")
            if text:
                return [(head + feed).encode(), *self._ends(text)]
            return [(head + feed).encode()]
        return self._ends(text)

    def _ends(self, text: str) -> list[bytes]:
        core = text.rstrip(MARKS)
        if core == text or not core or core[-1] + text[len(core)] in self.inner:
            return [text.encode()]
        return [core.encode(), text[len(core):].encode()]

    def cut(self, data: bytes) -> list[bytes]:
        """The words of a text, each without the space before it.

        A space stands before the text. Further spaces of a run go with the word after them, and
        the spaces at the end with the last one. A line feed begins a word, without a space before
        it, unless it has a piece.
        """
        if not data:
            return []
        mark = SPACE.encode()
        if mark in data:  # the mark in a text is a space
            data = data.replace(mark, b" ")
        if not self.line_feed:
            data = data.replace(b"\n", b" \n")
        parts = data.split(b" ")
        if b"" not in parts:
            return parts
        out, held = [], 0
        for part in parts[:-1]:
            if part:
                out.append(b" " * held + part)
                held = 0
            else:
                held += 1
        out.append(b" " * held + parts[-1])
        return out

    def encode(self, data: list[bytes]) -> list[np.ndarray]:
        """The ids of each UTF-8 text, without begin and end ids."""
        out: list[np.ndarray] = []
        for group in in_groups(map(self.cut, data), GROUP_WORDS):
            ids, sizes = self.words(group)
            out += np.split(ids, np.cumsum(sizes)[:-1])
        return out

    def token_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for, with spaces for their mark."""
        length = self.length[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.start[ids] - (ends - length), length)
        return self.bytes[shift + np.arange(total)].tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of an id sequence in UTF-8, less the space that encoding puts in front.

        Sequences that hold no encoded text (broken characters) go to the library.
        """
        found = self.token_bytes(ids)
        try:
            found.decode()
        except UnicodeDecodeError:
            return self.model.decode([int(i) for i in ids]).encode()
        return found.removeprefix(b" ")


def coder(path: str) -> Pieces:
    """The worker's own coder for a model."""
    return worker_state(f"pieces {path}", lambda: Pieces(path))


def piece_count(path: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def _with_marks(pieces: Pieces, coded: list[np.ndarray]) -> Iterator[np.ndarray]:
    first, last = np.array([pieces.bos], np.uint32), np.array([pieces.eos], np.uint32)
    return (np.concatenate([first, ids, last]) for ids in coded)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of each document, with begin and end ids."""
    def make():
        pieces = coder(path)

        def work(batch: pa.RecordBatch) -> dict:
            coded = pieces.encode(texts(batch.column("text")))
            return {"doc_id": batch.column("doc_id"),
                    "ids": [i.astype(np.int32) for i in _with_marks(pieces, coded)]}

        return work

    return map_batches(keyed(docs), make, "doc_id long, ids array<int>")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, and decoded from the ids."""
    def make():
        pieces = coder(path)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for ids in _with_marks(pieces, pieces.encode(texts(batch.column("text")))):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(pieces.decode(ids)).hexdigest())
            return {"doc_id": batch.column("doc_id"), **out}

        return work

    return map_batches(keyed(docs), make, "doc_id long, n_tokens long, ids_sha256 string, "
                       "decoded_sha256 string")
