"""A corpus pipeline: raw documents to decoded token ids, stage by stage.

Each stage takes all documents that its predecessor kept and returns the columns of documents; the
last returns token counts and checksums. Rejected documents go, removed passages and personal data
are cut from the texts.

Nulls: a null or empty text has too few words for the quality rules and goes; stages called on their
own keep it as it is, and the last one gives it no tokens. Rows that share an id are judged one by one;
near duplicates keep one of them, and every row with a null id. Of equally near copies the smallest id
stays. Texts of any length are read whole. Further columns, whatever their names are, stay with their
rows up to the last stage. An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import bpe, decontaminate, neardup, pii, quality
from ordermill.llm.queries import BPE_FILE
from ordermill.llm.words import stored


def _counted(docs: DataFrame) -> DataFrame:
    """The documents with ``n_chars`` of their new texts; an unknown text keeps its number."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _counted(decontaminate.cleaned(docs, benchmark))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _counted(pii.redact(docs))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and checksum of each text's ids, and the checksum of what they decode to."""
    return bpe.round_trips(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", private_data),
    ("byte-level bpe", byte_bpe),
]

#: Classifiers and tokenizers are beyond SQL; tests check the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
