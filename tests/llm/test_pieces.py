"""The piece encoder against the library, on odd and very long texts."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ordermill.llm import pieces as pieces_module
from ordermill.llm.pieces import Pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", " ", "  ", "▁", "ing", "\n", "\t", "é", "北", "🙂", "\x00", "́", "ab",
         "er", " t", "<0x41>", "<s>", "</s>", "<unk>", "�", "\xa0", "=", "==", "--", "\r", "1",
         "00", ".", ",", "...", "\x85", "﻿", "ﬁ", "\U0010ffff", "​", "\n\n", "?!", "$$$"]


@pytest.fixture(scope="module")
def own():
    return Pieces(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(own, library, texts):
    for text, ids in zip(texts, own.encode([t.encode() for t in texts]), strict=True):
        expected = library.encode(text)
        assert ids.tolist() == expected, text[:80]
        assert own.decode(ids).decode() == library.decode(expected), text[:80]


def test_odd_texts(own, library):
    rng = random.Random(1)
    same(own, library, ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
                        for _ in range(8000)])
    same(own, library, ["".join(rng.choice("aabt eh▁ \n.,") for _ in range(rng.randint(0, 30)))
                        for _ in range(8000)])


def test_runs_and_long_words(own, library):
    rng = random.Random(2)
    texts = [c * n for c in " =-a0x\n▁北🙂" for n in (1, 2, 3, 7, 16, 17, 33, 200)]
    texts.append("".join(rng.choice("abcdefgh") for _ in range(20_000)))
    same(own, library, texts)


def test_text_of_many_megabytes(own, library):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(500)]
    text = " ".join(rng.choice(words) for _ in range(1_000_000))
    same(own, library, [text])


def test_known_words_are_forgotten_in_time(library, monkeypatch):
    monkeypatch.setattr(pieces_module, "KNOWN_WORDS", 50)
    monkeypatch.setattr(pieces_module, "KNOWN_CORES", 50)
    monkeypatch.setattr(pieces_module, "KNOWN_PAIRS", 20)
    rng = random.Random(4)
    small = Pieces(PATH)
    for _ in range(5):
        same(small, library, [" ".join(rng.choice(PARTS) + rng.choice("xyz") for _ in range(60))])
    assert len(small.pairs) <= 20


def test_pairs_agree_with_whole_merges(own):
    """Chains give the same answer as running the merges of both pieces' text."""
    rng = random.Random(5)
    names = [p for p in own.plain if len(p) < 8]
    for _ in range(20_000):
        left, right = rng.choice(names), rng.choice(names)
        assert own.goes_with(left, right) == (own._merged(left + right)[0] == [left, right])


def test_ids_of_broken_characters(own, library):
    ids = [1, int(own.byte_id[0xE5]), 2, 300]
    assert own.decode(np.array(ids)).decode() == library.decode(ids)


def test_encoded_table(spark, library):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, None, "z"), (2, "", "")],
                                 "doc_id long, text string, ids string")
    found = sorted((tuple(r) for r in pieces_module.encoded(docs, PATH).collect()), key=repr)
    whole = library.encode("a b", add_bos=True, add_eos=True)
    assert found == sorted([(1, whole), (1, whole), (None, [1, 2]), (2, [1, 2])], key=repr)
