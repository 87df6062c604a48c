"""Token files: independent zstandard frames, a seek table, a checksum per frame.

A file is::

    frame 0 .. frame k-1   zstandard, each readable alone: token ids of whole documents
    index                  zstandard: per document its id, number of ids, and frame
    seek table             a skippable frame: per frame the size before and after, and a CRC-32
    footer                 sizes of the two parts before, and a magic word

Ids are little-endian unsigned 32-bit integers. A reader takes footer, seek table and index from
the end of a file and decompresses only the frames of the documents it wants.

Documents are range partitioned and sorted by id, so files hold ascending ids. Tasks write files
under names of their own attempt; a manifest table lists the files of the attempts that count, so
a task that is run again, or twice at once, leaves no wrong data. Rows that share an id are ordered
by a hash of their text, then by the text.

Nulls: a null text is empty and holds the end id alone; null ids come first. A text of any length is
one document in one frame. An empty table gives no file and an empty manifest. Other columns of the
table are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.words import Coder, in_groups, keyed, texts, worker_state

MAGIC = 0x4C494D31
SKIPPABLE = 0x184D2A5E
FRAME_IDS = 65_536
FILE_IDS = 16_000_000
FILE_DOCS = 500_000
#: Sizes of index and seek table, their checksum, the magic word.
FOOTER = "<IIII"
FOOTER_SIZE = struct.calcsize(FOOTER)
KNOWN_WORDS = 600_000

ROW = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8"), ("frame", "<u4")])
SEEK = np.dtype([("packed", "<u8"), ("plain", "<u8"), ("crc", "<u4")])
MANIFEST = ("file string, first_id long, last_id long, first_tie long, n_docs long, n_ids long")


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder or file, as executors see it."""
    local = re.match(r"^(?:file:/*(?=/))?(/.*)$", uri)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(uri)


class FileWriter:
    """Writes one token file from documents in order."""

    def __init__(self, folder: str):
        self.files, base = place(folder)
        self.name = f"{uuid.uuid4().hex}.tokens"
        self.files.create_dir(base, recursive=True)
        self.out = self.files.open_output_stream(f"{base}/{self.name}")
        self.pack = zstandard.ZstdCompressor(level=1, write_checksum=True)
        self.rows: list[tuple] = []
        self.seek: list[tuple] = []
        self.held: list[bytes] = []
        self.held_ids = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id or 0, doc_id is None, len(ids), len(self.seek)))
        self.held.append(ids.astype("<u4").tobytes())
        self.held_ids += len(ids)
        self.n_ids += len(ids)
        if self.held_ids >= FRAME_IDS:
            self._frame()

    def _frame(self) -> None:
        plain = b"".join(self.held)
        packed = self.pack.compress(plain)
        self.out.write(packed)
        self.seek.append((len(packed), len(plain), zlib.crc32(plain)))
        self.held, self.held_ids = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        index = self.pack.compress(np.array(self.rows, ROW).tobytes())
        table = np.array(self.seek, SEEK).tobytes()
        self.out.write(index + struct.pack("<II", SKIPPABLE, len(table)) + table
                       + struct.pack(FOOTER, len(index), len(table), zlib.crc32(index + table),
                                     MAGIC))
        self.out.close()


class FileReader:
    """Reads documents of one token file, frame by frame."""

    def __init__(self, folder: str, name: str):
        files, base = place(folder)
        self.source = files.open_input_file(f"{base}/{name}")
        self.unpack = zstandard.ZstdDecompressor()
        size = self.source.size()
        index_size, table_size, crc, magic = struct.unpack(
            FOOTER, self._bytes(size - FOOTER_SIZE, FOOTER_SIZE))
        if magic != MAGIC:
            raise ValueError(f"{name} is no whole token file")
        begin = size - FOOTER_SIZE - table_size - 8 - index_size
        tail = self._bytes(begin, index_size + 8 + table_size)
        index, table = tail[:index_size], tail[index_size + 8:]
        if zlib.crc32(index + table) != crc:
            raise ValueError(f"{name}: the index is damaged")
        self.rows = np.frombuffer(self.unpack.decompress(index), ROW)
        self.seek = np.frombuffer(table, SEEK)
        self.at = np.cumsum(self.seek["packed"]) - self.seek["packed"]

    def _bytes(self, begin: int, size: int) -> bytes:
        return self.source.read_at(size, int(begin))

    def frame(self, number: int) -> np.ndarray:
        entry = self.seek[number]
        plain = self.unpack.decompress(self._bytes(self.at[number], int(entry["packed"])),
                                       max_output_size=int(entry["plain"]))
        if zlib.crc32(plain) != entry["crc"]:
            raise ValueError(f"frame {number} is damaged")
        return np.frombuffer(plain, "<u4")

    def documents(self, wanted: np.ndarray | None = None) -> Iterator[tuple]:
        """``doc_id, ids, ids before it in the file`` of all documents, or those wanted by id."""
        n = self.rows["n"].astype(np.int64)
        before = np.cumsum(n) - n
        pick = (np.arange(len(self.rows)) if wanted is None else np.flatnonzero(
            np.isin(self.rows["doc_id"], wanted) & (self.rows["null"] == 0)))
        number, ids, start = -1, None, 0
        for i in pick.tolist():
            row = self.rows[i]
            if row["frame"] != number:
                number = int(row["frame"])
                ids = self.frame(number)
                start = int(before[np.searchsorted(self.rows["frame"], number)])
            at = int(before[i]) - start
            yield (None if row["null"] else int(row["doc_id"]), ids[at:at + int(n[i])],
                   int(before[i]))


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers spell bytes: printable ones as themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


BYTE_LETTERS = _byte_letters()
#: Words of these letters, lowered one by one, are in normal form C.
LATIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


class WordEncoder:
    """A tokenizer of words, applied to each distinct word once.

    The tokenizer drops white space and never joins words across it, and lower-cases its input, so
    a text's ids are those of its lower-cased words on end. A final full stop or comma after an
    ASCII letter is a token of its own. Words of Latin letters go straight to the tokenizer's model:
    all that stands in front of it would do is to lower them and to spell their bytes as letters.
    A text with a special mark, which has its own id, goes to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.cores = Coder(self._encode, KNOWN_WORDS)
        self.words = Coder(self._words, KNOWN_WORDS)

    def _plain(self, words: list[bytes]) -> list[list[int]]:
        tokenize, found = self.model.tokenize, []
        for word in words:
            if not word.isalpha():
                text = word.decode()
                if not LATIN.fullmatch(text):
                    found.append(None)
                    continue
                word = text.lower().encode()
            found.append([t.id for t in tokenize(word.decode("latin-1").translate(BYTE_LETTERS))])
        rest = [i for i, f in enumerate(found) if f is None]
        coded = self.tokenizer.encode_batch_fast([words[i].decode() for i in rest],
                                                 add_special_tokens=False)
        for i, own in zip(rest, coded, strict=True):
            found[i] = own.ids
        return found

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, length = [np.zeros(0, np.uint32)], []
        for begin in range(0, len(words), 10_000):
            found = self._plain(words[begin:begin + 10_000])
            length += [len(f) for f in found]
            flat.append(np.fromiter((i for f in found for i in f), np.uint32))
        return np.concatenate(flat), np.array(length, np.int64)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.cores([[w[:-1], w[-1:]] if w[-1:] in (b".", b",") and w[-2:-1].isalpha()
                           else [w] for w in words])

    def encode(self, data: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        marked = [any(m in d for m in self.marks) for d in data]
        rest = ([] if m else d.lower().split() for d, m in zip(data, marked, strict=True))
        for group in in_groups(rest):
            ids, sizes = self.words(group)
            out += np.split(ids, np.cumsum(sizes)[:-1])
        for i in np.flatnonzero(marked).tolist():
            whole = self.tokenizer.encode(data[i].decode(), add_special_tokens=False)
            out[i] = np.array(whole.ids, np.uint32)
        return out


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes all documents' ids, each with the end id, and returns the manifest table."""
    spark = docs.sparkSession
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = keyed(docs).withColumn("tie", tie)
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_state(f"words {tokenizer}", lambda: WordEncoder(tokenizer))
        writer, first = None, None
        done: list[tuple] = []

        def close() -> None:
            writer.close()
            ids = [None if r[1] else r[0] for r in writer.rows]
            done.append((writer.name, ids[0], ids[-1], first, len(ids), writer.n_ids))

        for batch in batches:
            names, ties = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()
            coded = encoder.encode(texts(batch.column("text")))
            for name, own_tie, ids in zip(names, ties, coded, strict=True):
                if writer is None:
                    writer, first = FileWriter(folder), own_tie
                writer.add(name, np.append(ids, np.uint32(end_id)))
                if writer.n_ids >= FILE_IDS or len(writer.rows) >= FILE_DOCS:
                    close()
                    writer = None
        if writer is not None:
            close()
        yield pa.RecordBatch.from_pylist(
            [dict(zip([c.split()[0] for c in MANIFEST.split(", ")], d, strict=True))
             for d in done], schema=pa.schema(
                [(c.split()[0], pa.string() if "string" in c else pa.int64())
                 for c in MANIFEST.split(", ")]))

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file in order of ids, with the number of ids in all files before it."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per file of FILE_IDS ids: the only thing that is ever put in one order.
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_tie", "file").rowsBetween(
        Window.unboundedPreceding, -1)
    return files.withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """``doc_id, start, ids`` of all documents, or of those wanted, from their frames alone."""
    return _read(spark, folder, wanted, "doc_id long, start long, ids array<int>",
                 lambda ids: {"ids": ids.astype(np.int32)})


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, read back from the files."""
    return _read(spark, folder, None, "doc_id long, start long, n_tokens long, ids_crc32 long",
                 lambda ids: {"n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())})


def _read(spark: SparkSession, folder: str, wanted: list[int] | None, schema: str,
          columns) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    files = manifest(spark, folder)
    pick = None
    if wanted is not None:
        pick = np.array(sorted(set(wanted)), np.int64)
        low, high = (int(pick[0]), int(pick[-1])) if len(pick) else (1, 0)
        files = files.filter((F.col("last_id") >= low)
                             & (F.coalesce("first_id", F.lit(low)) <= high))
    struct_type = spark.createDataFrame([], schema).schema
    arrow = to_arrow_schema(struct_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for doc_id, ids, before in FileReader(folder, row["file"]).documents(pick):
                    held.append({"doc_id": doc_id, "start": row["ids_before"] + before,
                                 **columns(ids)})
                    size += len(ids)
                    if size >= FRAME_IDS * 16:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)

    # The window left all files in one partition. With a fixed number of tasks, one per file, Spark
    # does not put them together again for being short rows.
    return (files.select("file", "ids_before").repartition(max(1, files.count()), "file")
            .mapInArrow(run, struct_type))
