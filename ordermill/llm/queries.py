"""Every operator of this package as a named query, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    alignment,
    bpe,
    decontaminate,
    neardup,
    pieces,
    pii,
    quality,
    shards,
    substrings,
    tokencounts,
    tokenfile,
    urlrules,
    whitening,
)
from ordermill.session import new_scratch

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
SECTION_FILE = "byte_bpe_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
END_ID = 2
SHARDS = 40


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trips(_table(spark, folder, "documents"), public_tokenizers.path(BPE_FILE),
                           public_tokenizers.PATTERN)


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"))


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch(spark, "tokens")
    tokenfile.write(_table(spark, folder, "documents"), path, public_tokenizers.path(WORD_FILE),
                    END_ID)
    return tokenfile.checksums(spark, path)


def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return urlrules.judge(_table(spark, folder, "pages"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, folder, "documents"),
                                        _table(spark, folder, "benchmark"))
    hits = F.aggregate(F.zip_with("end", "begin", lambda e, b: e - b), F.lit(0).cast("long"),
                       lambda a, x: a + x)
    return (found.withColumn("n_hit", hits).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated")))


def sharding(spark: SparkSession, folder_of_tables: str) -> DataFrame:
    folder = new_scratch(spark, "slot-maps")
    first = shards.SlotMap.of(SHARDS)
    first.publish(spark, folder)
    grown = shards.SlotMap.load(spark, folder).grown()
    grown.publish(spark, folder)
    return shards.assign(_table(spark, folder_of_tables, "documents"), folder, first.version,
                         grown.version)


def private_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(_table(spark, folder, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    order = [*pii.KINDS, *pii.GENERATORS]
    return found.select("doc_id", *[number(k) for k in pii.KINDS],
                        F.sha2(pii.joined(F.col("base"), order), 256).alias("base_sha256"),
                        pii.joined(F.col("spans"), order).alias("spans"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality.judge(docs, quality.train(docs, _table(spark, folder, "labels")))


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.section_counts(_table(spark, folder, "documents"),
                                      public_tokenizers.path(SECTION_FILE),
                                      public_tokenizers.PATTERN)


def repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_passages(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trips(_table(spark, folder, "documents"),
                              public_tokenizers.path(PIECE_FILE))


def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment_counts(_table(spark, folder, "documents"),
                                      public_tokenizers.path(BYTE_FILE),
                                      public_tokenizers.path(PIECE_FILE))


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": byte_bpe,
        "op2_near_duplicates": near_duplicates,
        "op3_token_files": token_files,
        "op4_url_rules": url_rules,
        "op5_decontamination": decontamination,
        "op6_sharding": sharding,
        "op7_private_data": private_data,
        "op8_quality_rules": quality_rules,
        "op9_token_counts": token_counts,
        "op10_repeated_substrings": repeated_substrings,
        "op11_sentence_pieces": sentence_pieces,
        "op12_token_alignment": token_alignment,
        "op13_embedding_whitening": embedding_whitening,
    }


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, lowered: bool) -> str:
    text = "coalesce(text, '')"
    if lowered:
        text = f"translate({text}, '{UPPER}', '{LOWER}')"
    return f"regexp_extract_all({text}, '{pattern}')"


NEAR_DUPLICATES = f"""WITH RECURSIVE split AS (
  SELECT doc_id, {_words(SPACED, True)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3),
      lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*))),
reached(a, b) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
components AS (SELECT a, MIN(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components ON a = doc_id"""

DECONTAMINATION = f"""WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_words(ITEM_WORDS, True)} AS w FROM benchmark
  WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
      lambda i: array_to_string(w[i:i + 9], ' '))) AS gram
  FROM items WHERE len(w) > 0),
texts AS (SELECT doc_id, {_words(ITEM_WORDS, True)} AS w FROM documents),
grams AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w
  FROM texts, (SELECT DISTINCT size FROM windows)),
found AS (
  SELECT g.doc_id, g.i, g.size, v.item FROM grams g JOIN windows v
    ON v.size = g.size AND v.gram = array_to_string(g.w[g.i:g.i + g.size - 1], ' ')),
hits AS (
  SELECT doc_id, COUNT(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
names AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit,
  COALESCE(n_items, 0) AS n_items, sha256(COALESCE(names, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM texts t LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)"""

REPEATED_SUBSTRINGS = f"""WITH texts AS (
  SELECT doc_id, {_words(SPACED, False)} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM texts),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS own FROM starts),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY own) AS n FROM windows) WHERE n > 1),
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts),
marked AS (
  SELECT doc_id, word, place, gone.place IS NOT NULL AS removed
  FROM words LEFT JOIN gone USING (doc_id, place)),
kept AS (
  SELECT doc_id, COUNT(*) FILTER (removed) AS n_removed,
    string_agg(word, ' ' ORDER BY place) FILTER (NOT removed) AS body
  FROM marked GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_removed, 0) AS n_removed,
  sha256(COALESCE(body, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)"""


# Every combination of a URL's useful tokens is grown token by token and counted in both halves. A
# URL matches if any of its combinations is a rule, so it does not matter that the operator keeps only
# the shortest.
WILSON = """((b / n) + 2.706025 / (2 * n) - 1.645 * sqrt(((b / n) * (1 - b / n)
    + 2.706025 / (4 * n)) / n)) / (1 + 2.706025 / n)"""


def _bound(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0 ELSE " + WILSON.replace("b /", f"{part} /").replace(
        "/ n", f"/ {whole}").replace("* n)", f"* {whole})") + " END"


URL_RULES = f"""WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'),
  ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
urls AS (
  SELECT row_number() OVER () AS n, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
fixed AS (
  SELECT n, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY n),
tokens AS (
  SELECT DISTINCT n, kind || token AS token FROM (
    SELECT n, 'host:' AS kind, unnest(string_split(host, '.')) AS token FROM parts
    UNION ALL SELECT n, 'path:', unnest(string_split(path, '/')) FROM parts
    UNION ALL SELECT n, 'type:', regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1) FROM parts
    UNION ALL SELECT n, 'key:', regexp_extract(unnest(string_split(
      regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&')), '^[^=]*') FROM parts
    UNION ALL SELECT n, 'part:', regexp_extract(rest, '#(.*)', 1) FROM parts)
  WHERE token <> ''),
labelled AS (
  SELECT n, verdict = 'block' AS bad, substr(md5(host), 1, 1) >= '8' AS held
  FROM fixed JOIN parts USING (n)),
total AS (SELECT COUNT(*) FILTER (NOT held) AS rows FROM labelled),
useful AS (
  SELECT token FROM tokens JOIN labelled USING (n) GROUP BY token
  HAVING COUNT(*) FILTER (bad AND NOT held) >= ceil(0.01 * (SELECT rows FROM total))
    AND COUNT(*) FILTER (NOT held) < 0.99 * (SELECT rows FROM total)
    AND token NOT IN (SELECT 'host:' || h FROM rules)
    AND token NOT IN (SELECT 'path:' || unnest(string_split(p, '/')) FROM rules)
    AND NOT (starts_with(token, 'host:') AND bool_and(bad))),
used AS (SELECT * FROM tokens SEMI JOIN useful USING (token)),
sets(n, items, top) AS (
  SELECT n, [token], token FROM used
  UNION ALL SELECT s.n, list_append(s.items, u.token), u.token
  FROM sets s JOIN used u ON u.n = s.n AND u.token > s.top),
counted AS (
  SELECT items, COUNT(*) FILTER (NOT held) AS n, COUNT(*) FILTER (bad AND NOT held) AS b,
    COUNT(*) FILTER (held) AS nn, COUNT(*) FILTER (bad AND held) AS bb
  FROM sets JOIN labelled USING (n) GROUP BY items),
mined AS (
  SELECT items FROM counted WHERE b >= ceil(0.01 * (SELECT rows FROM total))
    AND {_bound('b', 'n')} >= 0.95 AND {_bound('bb', 'nn')} >= 0.95),
hit AS (SELECT DISTINCT n FROM sets SEMI JOIN mined USING (items))
SELECT page_id, host, path, rule,
  COALESCE(fixed.verdict, CASE WHEN hit.n IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  rule IS NULL AND hit.n IS NOT NULL AS mined
FROM parts LEFT JOIN fixed USING (n) LEFT JOIN hit USING (n)"""


def oracle_sql() -> dict[str, str]:
    """The results that SQL can state on small tables.

    Tokenizers, trained models and the slots' hash are beyond SQL; ``tests/llm`` checks those
    queries against a brute-force version.
    """
    return {
        "op2_near_duplicates": NEAR_DUPLICATES,
        "op4_url_rules": URL_RULES,
        "op5_decontamination": DECONTAMINATION,
        "op10_repeated_substrings": REPEATED_SUBSTRINGS,
    }
