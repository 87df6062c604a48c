"""Null ids, ids that repeat with equal and other texts, and a long text, against brute force."""

import random

import pytest

from ordermill.llm import queries as text_queries
from tests.llm import brute, cases
from tests.llm.test_queries import EXPECTED, rows, table

QUERIES = text_queries.queries()
#: Their own tests treat ids that repeat: there rows of one id belong together, or need an order.
ROW_BY_ROW = [n for n in EXPECTED if n not in (
    "op2_near_duplicates", "op3_token_files", "op10_repeated_substrings")]


@pytest.fixture(scope="module")
def messy(spark, tmp_path_factory):
    rng = random.Random(4)
    texts = [t for _, t in cases.documents()]
    docs = [(rng.choice([None, 1, 2, 3]), t) for t in texts + texts[5:20]]
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))) for _ in range(3_000)]
    docs.append((7, " ".join(rng.choice(words) for _ in range(4_000))))
    return cases.write(spark, str(tmp_path_factory.mktemp("messy")), rows=docs)


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_rows_count_one_by_one(spark, messy, name):
    expected, columns = EXPECTED[name]
    docs = table(spark, messy, "documents", "doc_id", "text")
    found = rows(QUERIES[name](spark, messy), *columns.split())
    assert found == sorted(expected(docs), key=repr)


def test_decontamination_row_by_row(spark, messy):
    docs = table(spark, messy, "documents", "doc_id", "text")
    items = table(spark, messy, "benchmark", "item_id", "text")
    found = rows(QUERIES["op5_decontamination"](spark, messy), "doc_id", "n_words", "n_hit",
                 "n_items", "items_sha256", "contaminated")
    assert found == sorted(brute.decontamination(docs, items), key=repr)


def test_token_files_hold_every_row(spark, messy):
    docs = table(spark, messy, "documents", "doc_id", "text")
    found = QUERIES["op3_token_files"](spark, messy).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(
        (d for d, _ in docs), key=lambda d: (d is not None, d or 0))
    ends = [r.start + r.n_tokens for r in found]
    assert [r.start for r in found] == [0, *ends[:-1]]
    own = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found)
    assert own == sorted((d is None, d or 0, n, crc) for d, _, n, crc in brute.token_files(docs))
