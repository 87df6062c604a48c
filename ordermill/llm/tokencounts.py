"""Token counts of the sections of a text, from one encoding of the whole text.

A text is encoded once. The byte lengths of its tokens give each token's place, and an interval
join with the sections' places attributes it. A token that crosses from one section into another
counts whole, by rule: ``first`` gives it to the section of its first character, ``most`` to the
section with most of its bytes, the earlier one at a tie. So counts of sections that cover a text
add up to the count of the text.

Sections are byte spans that a function finds in a text; they are in order and do not overlap.
Tokens in none of them count under a null section. Results hold code points.

Nulls: a null text is empty. A text without sections has one row with a null section and the count
of all its tokens. Repeated rows are counted one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm.bpe import read_ranks
from ordermill.llm.words import keyed, map_batches, texts, worker_state

Section = tuple[str, int, int]
RULES = ("first", "most")


def lines(data: bytes) -> list[Section]:
    """One section per line; a line holds the line feed that ends it."""
    parts = data.split(b"\n")
    sizes = [len(p) + 1 for p in parts[:-1]] + [len(parts[-1])]
    if not sizes[-1]:
        sizes.pop()
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [(f"line {i}", e - s, e) for i, (s, e) in enumerate(zip(sizes, ends, strict=True))]


def attributed(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, stops: np.ndarray,
               rule: str = "first") -> np.ndarray:
    """For each token span the number of its section, or -1."""
    if not len(starts):
        return np.full(len(begin), -1)
    low = np.searchsorted(starts, begin, "right") - 1
    inside = (low >= 0) & (begin < stops[np.maximum(low, 0)])
    owner = np.where(inside, low, -1)
    if rule == "most":
        high = np.searchsorted(starts, end, "left") - 1
        for i in np.flatnonzero(high > low).tolist():  # the few tokens that cross a start
            best = 0
            for s in range(max(int(low[i]), 0), int(high[i]) + 1):
                share = min(end[i], stops[s]) - max(begin[i], starts[s])
                if share > best:
                    best, owner[i] = share, s
    return owner


def section_counts(docs: DataFrame, path: str, pattern: str,
                   sections: Callable[[bytes], list[Section]] = lines,
                   rule: str = "first") -> DataFrame:
    """``doc_id, section, start, end, n_tokens, doc_tokens``, one row per section of a document."""
    if rule not in RULES:
        raise ValueError(f"no rule {rule}")

    def load():
        import tiktoken

        ranks = read_ranks(path)
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            length[number] = len(token)
        coder = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks,
                                  special_tokens={})
        return coder, length

    def make():
        coder, length = worker_state(f"sections {path} {pattern}", load)

        def work(batch: pa.RecordBatch) -> dict:
            names = ("doc_id", "section", "start", "end", "n_tokens", "doc_tokens")
            out: dict[str, list] = {n: [] for n in names}
            for doc_id, data in zip(batch.column("doc_id").to_pylist(),
                                    texts(batch.column("text")), strict=True):
                size = length[np.array(coder.encode_ordinary(data.decode()), np.int64)]
                end = np.cumsum(size)
                found = sections(data)
                starts = np.array([s[1] for s in found], np.int64)
                stops = np.array([s[2] for s in found], np.int64)
                owner = attributed(end - size, end, starts, stops, rule)
                count = np.bincount(owner + 1, minlength=len(found) + 1)
                lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
                points = np.concatenate(([0], np.cumsum(lead)))
                rows = len(found)
                if count[0] or not rows:
                    out["section"].append(None)
                    out["start"].append(0)
                    out["end"].append(int(points[-1]))
                    out["n_tokens"].append(int(count[0]))
                    rows += 1
                out["section"] += [s[0] for s in found]
                out["start"] += points[starts].tolist()
                out["end"] += points[stops].tolist()
                out["n_tokens"] += count[1:].tolist()
                out["doc_id"] += [doc_id] * rows
                out["doc_tokens"] += [len(size)] * rows
            return out

        return work

    return map_batches(keyed(docs), make, "doc_id long, section string, start int, end int, "
                       "n_tokens long, doc_tokens long")
