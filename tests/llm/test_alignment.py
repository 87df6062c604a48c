"""Lockstep merging against token spans, and its bounds."""

import random

import numpy as np
import public_tokenizers
import pytest

from ordermill.llm import alignment
from ordermill.llm.alignment import Aligned, Aligner, entries, merged
from tests.llm import brute

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def aligner():
    return Aligner(A, B)


def expected(a_end, b_end):
    a_begin, b_begin = [0, *a_end[:-1]], [0, *b_end[:-1]]
    return {(i, j) for i in range(len(a_end)) for j in range(len(b_end))
            if a_begin[i] < b_end[j] and b_begin[j] < a_end[i]}


def test_links_of_random_spans_in_entries_of_any_size():
    rng = np.random.default_rng(1)
    for _ in range(200):
        total = int(rng.integers(1, 60))
        a_end = np.append(np.sort(rng.choice(total, int(rng.integers(0, total)), False)), total)
        b_end = np.append(np.sort(rng.choice(total, int(rng.integers(0, total)), False)), total)
        a_end, b_end = a_end[a_end > 0], b_end[b_end > 0]
        for size in (1, 3, 1000):
            begin = np.array([0])
            split = entries(a_end, b_end, begin, np.array([len(a_end)]), begin, size)
            a, b, cut = merged(a_end, b_end, *split)
            assert len(a) == len(set(zip(a, b, strict=True)))
            assert set(zip(a.tolist(), b.tolist(), strict=True)) == expected(a_end, b_end)
            assert set(a_end[a[cut]]) == set(a_end) & set(b_end)


def test_long_documents_take_many_entries(aligner):
    text = b"some words, and others. " * 20_000
    found = Aligned(aligner, [text])
    split = entries(np.cumsum(aligner.a_length[found.a]),
                    np.cumsum(aligner.pieces.length[found.b]),
                    np.array([0]), np.array([len(found.a)]), np.array([0]))
    assert len(split[0]) > 50
    assert max(split[1] - split[0]) < 2 * alignment.ENTRY_TOKENS + alignment.SEARCH


def test_texts_without_a_common_end_stay_whole(aligner):
    rng = random.Random(2)
    texts = ["a▁b", "▁", "", "x" * 5000, "é" * 3000, "".join(map(chr, range(0x4E00, 0x4E80))),
             "<|endoftext|> <s> <0x41>", "\x1c\x85 ᠎ x ", "  two  spaces  \n\n"]
    texts += ["".join(rng.choice(["a", " ", "th", "北", "\n", "é", "1", "'s", "\xa0", "\x00"])
                      for _ in range(40)) for _ in range(200)]
    found = Aligned(aligner, [t.encode() for t in texts])
    digests = found.digests(aligner.a_names, aligner.b_names)
    links = np.bincount(found.doc_of_a[found.link_a], minlength=len(texts))
    rows = [(i, int(found.n_a[i]), int(found.n_b[i]), int(found.per_document(found.a_last)[i]),
             int(links[i]), digests[i]) for i in range(len(texts))]
    assert rows == [(*r[:5], r[7]) for r in brute.alignment(list(enumerate(texts)))]
    assert rows[0][1:] == rows[2][1:] == (0, 0, 0, 0, "")


def test_many_chunks_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 300)
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), " ".join(rng.choice(["one", "two", "trois", "vier,"])
             for _ in range(rng.randint(0, 30))) or None, 7) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk long").repartition(3)
    found = alignment.alignment_counts(docs, A, B)
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=repr) == sorted(
        brute.alignment([r[:2] for r in rows]), key=repr)


def test_alignments_keep_ids_groups_and_links(spark, aligner):
    docs = spark.createDataFrame([(1, "unbelievable words, indeed"), (2, None)],
                                 "doc_id long, text string")
    one, two = sorted(alignment.alignments(docs, A, B).collect())
    assert (two.a_ids, two.b_ids, two.link_a) == ([], [], [])
    a_end = np.cumsum(aligner.a_length[one.a_ids])
    b_end = np.cumsum(aligner.pieces.length[one.b_ids])
    assert a_end[np.array(one.a_cuts) - 1].tolist() == b_end[np.array(one.b_cuts) - 1].tolist()
    assert set(zip(one.link_a, one.link_b, strict=True)) == expected(a_end, b_end)


def test_words_of_the_first_tokenizer(aligner):
    rng = random.Random(5)
    parts = ["a", "it's", " ", "\n", "Word", ",", "...", "###", "é", "ö.", "北,", "1", "½.", "ª?",
             "\t", "  ", "́", "x́.", "'ll", "'", "\"", "ǆ!", "ʰ-", "ɐ.", "\x01", "$$", "\r\n", "_", "İ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    texts += [" ".join(rng.choice(parts).strip() or "x" for _ in range(9)) for _ in range(3000)]
    texts += ["\n".join(rng.choice(parts).strip() or "x" for _ in range(5)) for _ in range(1000)]
    found = aligner.ids([t.encode() for t in texts])[0]
    for text, ids in zip(texts, found, strict=True):
        expected = aligner.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        assert ids.tolist() == expected, text
