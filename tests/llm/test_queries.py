"""Each query against brute force, on the smallest test tables and on awkward rows."""

import pytest

from ordermill.llm import queries as text_queries
from tests.conftest import TEST_DATA
from tests.llm import brute, cases

QUERIES = text_queries.queries()


def table(spark, folder, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet")
            .select(*columns).collect()]


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


EXPECTED = {
    "op1_byte_bpe": (brute.byte_bpe, "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op2_near_duplicates": (brute.near_duplicates, "doc_id n_shingles component_id kept"),
    "op3_token_files": (brute.token_files, "doc_id start n_tokens ids_crc32"),
    "op7_private_data": (brute.private_data, "doc_id n_email n_ip n_card n_phone base_sha256"),
    "op8_quality_rules": (brute.quality, "doc_id n_words word_chars n_symbols n_dup_lines "
                                         "n_repeat_words base_failed"),
    "op9_token_counts": (brute.section_counts, "doc_id section start end n_tokens doc_tokens"),
    "op10_repeated_substrings": (brute.repeated_substrings,
                                 "doc_id n_words n_removed kept_sha256"),
    "op11_sentence_pieces": (brute.sentence_pieces,
                             "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op12_token_alignment": (brute.alignment, "doc_id n_a n_b n_groups n_links n_best count_sum "
                                              "groups_sha256"),
}


@pytest.mark.parametrize("where", ["given", "edge"])
@pytest.mark.parametrize("name", EXPECTED)
def test_query_equals_brute_force(spark, folder, name, where):
    place = TEST_DATA if where == "given" else folder
    expected, columns = EXPECTED[name]
    docs = table(spark, place, "documents", "doc_id", "text")
    found = rows(QUERIES[name](spark, place), *columns.split())
    assert found == sorted(expected(docs), key=repr)


@pytest.mark.parametrize("where", ["given", "edge"])
def test_decontamination(spark, folder, where):
    place = TEST_DATA if where == "given" else folder
    docs = table(spark, place, "documents", "doc_id", "text")
    items = table(spark, place, "benchmark", "item_id", "text")
    found = rows(QUERIES["op5_decontamination"](spark, place), "doc_id", "n_words", "n_hit",
                 "n_items", "items_sha256", "contaminated")
    assert found == sorted(brute.decontamination(docs, items), key=repr)
    assert any(r[-1] for r in found)


@pytest.mark.parametrize("where", ["given", "edge"])
def test_url_rules(spark, folder, where):
    place = TEST_DATA if where == "given" else folder
    pages = table(spark, place, "pages", "page_id", "url")
    found = rows(QUERIES["op4_url_rules"](spark, place), "page_id", "host", "path", "rule",
                 "verdict")
    expected = sorted(brute.fixed_rules(pages), key=repr)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert all(f[4] == (e[4] or f[4]) in ("allow", "block")
               for f, e in zip(found, expected, strict=True))


@pytest.mark.parametrize("where", ["given", "edge"])
def test_sharding(spark, folder, where):
    place = TEST_DATA if where == "given" else folder
    import zlib

    docs = dict(table(spark, place, "documents", "doc_id", "text"))
    found = QUERIES["op6_sharding"](spark, place).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    places = {}
    for r in found:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).collect() == []


def test_verdicts_and_added_spans_keep_the_base(spark):
    judged = QUERIES["op8_quality_rules"](spark, TEST_DATA).collect()
    assert not any(r.kept and r.base_failed for r in judged)
    docs = dict(table(spark, TEST_DATA, "documents", "doc_id", "text"))
    for r in QUERIES["op7_private_data"](spark, TEST_DATA).collect():
        base = {f"{k}:{a}:{b}" for k, a, b in brute.base_spans(docs[r.doc_id])}
        assert base <= set(r.spans.split(",")) | ({""} if not base else set())


def test_cases_have_what_they_promise():
    texts = [t for _, t in cases.documents()]
    assert None in texts and "" in texts and len(set(texts)) < len(texts)
