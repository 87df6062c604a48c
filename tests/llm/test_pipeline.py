"""The pipeline's stages, one by one and together."""

import re

import pytest

import corpus_pipeline
from ordermill.llm import quality
from tests.conftest import TEST_DATA
from tests.llm import brute


def docs_of(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_quality_stage_keeps_what_the_query_keeps(spark):
    docs = docs_of(spark, TEST_DATA)
    model = quality.train(docs, spark.read.parquet(f"{TEST_DATA}/labels.parquet"))
    kept = {r.doc_id for r in quality.judge(docs, model).filter("kept").collect()}
    stage = corpus_pipeline.quality_rules(spark, docs, TEST_DATA)
    assert stage.columns == docs.columns
    assert sorted(stage.collect()) == sorted(r for r in docs.collect() if r.doc_id in kept)


@pytest.mark.parametrize("where", ["given", "edge"])
def test_near_duplicates_leave_one_of_each_group(spark, folder, where):
    docs = docs_of(spark, TEST_DATA if where == "given" else folder)
    stage = corpus_pipeline.near_duplicates(spark, docs, TEST_DATA)
    kept = {r[0] for r in brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()])
            if r[3]}
    assert stage.columns == docs.columns
    assert sorted(stage.collect(), key=repr) == sorted(
        (r for r in docs.collect() if r.doc_id in kept), key=repr)


@pytest.mark.parametrize("where", ["given", "edge"])
def test_decontaminated_texts_have_no_hit_word_left(spark, folder, where):
    place = TEST_DATA if where == "given" else folder
    docs = docs_of(spark, place)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{place}/benchmark.parquet")
             .collect()]
    before = {r.doc_id: r for r in docs.collect()}
    hits = {r[0]: r for r in brute.decontamination([(d, r.text) for d, r in before.items()], items)}
    stage = corpus_pipeline.decontamination(spark, docs, place)
    assert stage.columns == docs.columns
    for r in stage.collect():
        old, (_, n_words, n_hit, *_) = before[r.doc_id], hits[r.doc_id]
        if not n_hit:
            assert r == old
        else:
            left = brute.ITEM_WORD.findall(r.text.translate(brute.LOWER))
            assert len(left) == n_words - n_hit
            assert r.n_chars == len(r.text)


@pytest.mark.parametrize("where", ["given", "edge"])
def test_private_data_is_replaced(spark, folder, where):
    place = TEST_DATA if where == "given" else folder
    docs = docs_of(spark, place)
    before = {r.doc_id: r.text for r in docs.collect()}
    stage = corpus_pipeline.private_data(spark, docs, place)
    assert stage.columns == docs.columns
    for r in stage.collect():
        spans = list(brute.base_spans(before[r.doc_id]))
        assert (r.text is None) == (before[r.doc_id] is None)
        for kind, begin, end in spans:
            own = before[r.doc_id][begin:end]
            if before[r.doc_id].count(own) == 1 and not any(
                    b < end and begin < e and (b, e) != (begin, end) for _, b, e in spans):
                assert own not in r.text
                assert f"[{kind.upper()}]" in r.text
        if not spans and r.text and not re.search("[0-9@]|[A-Za-z0-9_=-]{20}", r.text):
            assert r.text == before[r.doc_id] or "[" in r.text


def test_run_ends_with_ids_of_clean_texts(spark):
    docs = docs_of(spark, TEST_DATA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, TEST_DATA).collect(), docs.schema)
    expected = sorted(brute.byte_bpe([(r.doc_id, r.text) for r in docs.collect()]))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, TEST_DATA).collect()) == expected
    assert expected


def test_run_on_empty_tables(spark, empty_folder):
    assert corpus_pipeline.run(spark, empty_folder).collect() == []


def test_run_on_awkward_rows(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == [
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
