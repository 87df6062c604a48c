"""Personal data: fixed patterns, and spans that boosted trees select.

Four patterns with checks give the base spans. High-recall generators propose further candidates
that may overlap them and each other. Gradient-boosted trees, for each generator its own, judge a
candidate by its format and its context; they are trained on the candidates of all documents, by
weak labels. A number or contact counts as personal if a checked base span covers most of it, and a secret if a credential word introduces it (``password=``, ``token: "``);
the features do not show the mark that tells so (the plus sign, the kind of at sign, the credential
word and its quotes), so candidates without the mark can look like those with it. Candidates that
fail a check of their kind count as not personal (:func:`failed`, a feature, too), and so do those of
other generators, which are surely not of this kind. Others that no base span touches are
unlabelled: they are neither. The threshold is the lowest score whose precision on the held-out
third, among the kind's own labelled candidates, is at least ``PRECISION``. A generator without a
positive label adds nothing. Selected candidates that no base span touches are added, longest first
where they overlap; base spans always stay.

All of it is built-in functions: patterns cut a text into gaps and matches, whose lengths give the
places, and the trees become ``CASE`` expressions over a candidate's features, so no text is
shuffled. For training, candidates with the same features and label become one weighted row, which
gives the same trees; there are far fewer of these rows than candidates.

Places are code points, the end exclusive. Nulls: a null text is empty and has no spans. Repeated
rows are judged one by one. Texts of any length are read whole; no pattern backtracks more than one
run of characters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.words import stored

PRECISION = 0.98
#: A tree's leaf has at least so many candidates.
LEAST_LEAF = 5
#: Training rows that one task takes at most, on average.
ROWS_A_TASK = 100_000
KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that the search never tries a run of characters twice. The look
# behind, or the end of the match before, stands for "leftmost": within one run a later start
# cannot match where the first did not.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

# Candidates: numbers in groups, words joined by a spelled or real at sign, long mixed tokens.
GENERATORS = {
    "number": r"\(?[0-9](?:[ ().+-]*+[0-9])++",
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?\[at\] ?| ?\(at\) ?|@)"
               r"[A-Za-z0-9.-]++",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+(?![@A-Za-z0-9_-])",
}

#: Names made of words and whole numbers; no secret is proposed in such a form.
NAME = "^(?:[A-Za-z]+|[0-9]+)(?:[_-]+(?:[A-Za-z]+|[0-9]+))*[_-]*$"
#: What introduces a secret; it is the mark that gives weak labels.
CREDENTIAL = (r"(?i)(?:token|key|secret|password|passwd|pwd|credential|bearer)[a-z_]*[\"']?"
              r"\s*[=:]?\s*[\"']?$")

#: Shorter numbers are no candidates.
LEAST_NUMBER = 9
SPELLED = r" ?\[at\] ?| ?\(at\) ?"

#: A cheap condition that holds for every text with a match that passes its check.
HINTS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "phone": lambda text: F.contains(text, F.lit("+")),
    "card": lambda text: text.rlike("[0-9](?:[ -]?[0-9]){15}"),
    "contact": lambda text: text.rlike(r"@|[\[(]at[\])]"),
    "number": lambda text: text.rlike("[0-9(][0-9 ().+-]{7}"),
    "secret": lambda text: text.rlike("[A-Za-z0-9_-]{16}"),
}

SPAN = "struct<kind:string,start:int,end:int,text:string>"


def _spans(text: Column, kind: str, pattern: str, hint: Callable | None = None) -> Column:
    """All matches of a pattern with their places."""
    matched = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["match"]), F.lit(0))
        found = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                         pair["match"].alias("text"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(found)).alias("spans"))

    zipped = F.arrays_zip(gaps.alias("gap"), matched.alias("match"))
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    folded = F.aggregate(zipped, first, step, lambda s: s["spans"])
    found = F.filter(folded, lambda s: s["text"].isNotNull())
    none = F.array().cast(f"array<{SPAN}>")
    seen = hint(text) if hint else text.rlike(pattern)
    return F.when(seen, found).otherwise(none)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits is right."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
            (d.try_cast("int") * 2) % 10 + F.when(d >= "5", 1).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _checked(spans: Column, kind: str) -> Column:
    if kind == "ip":
        small = r"^(?:0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
        return F.filter(spans, lambda s: s["text"].rlike(small))
    if kind == "card":
        return F.filter(spans, lambda s: F.length(_digits(s["text"])).between(16, 19)
                        & luhn(_digits(s["text"])))
    if kind == "phone":
        return F.filter(spans, lambda s: F.length(_digits(s["text"])).between(8, 15))
    return spans


def with_base(docs: DataFrame) -> DataFrame:
    """Adds ``base``: the base spans by kind, then place. ``docs`` has ``text``, never null."""
    for kind in KINDS:
        # Two steps, so that the check reads the matches once.
        docs = docs.withColumn(f"_{kind}", _spans(
            F.col("text"), kind, PATTERNS[kind], HINTS.get(kind)))
        docs = docs.withColumn(f"_{kind}", _checked(F.col(f"_{kind}"), kind))
    return (docs.withColumn("base", F.concat(*[F.col(f"_{k}") for k in KINDS]))
            .drop(*[f"_{k}" for k in KINDS]))


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``candidates``: what the generators propose, with 24 code points before and 1 after."""
    found = F.concat(*[_spans(F.col("text"), k, p, HINTS.get(k)) for k, p in GENERATORS.items()])
    found = F.filter(found, lambda s: F.when(
        s["kind"] == "number", s["end"] - s["start"] >= LEAST_NUMBER
    ).when(s["kind"] == "secret", ~s["text"].rlike(NAME) | s["text"].rlike("^[0-9]+$"))
     .otherwise(F.lit(True)))
    context = F.transform(F.col("candidates"), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["text"].alias("text"),
        F.substring(F.col("text"), F.greatest(s["start"] - 23, F.lit(1)),
                    F.least(s["start"], F.lit(24))).alias("before"),
        F.substring(F.col("text"), s["end"] + 1, F.lit(1)).alias("after")))
    return docs.withColumn("candidates", found).withColumn("candidates", context)


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, letters, ""))


def features(span: Column) -> list[Column]:
    """Format and context of a candidate, as numbers; none shows the mark of a positive label."""
    text = F.regexp_replace(span["text"], SPELLED, "@")
    before = F.when(span["kind"] == "secret", F.lit("")).otherwise(
        F.regexp_replace(F.lower(span["before"]), r"\+$", ""))
    after = F.when(span["kind"] == "secret", F.lit("")).otherwise(span["after"])
    found = [
        F.length(text), _count(text, "[0-9]"), _count(text, "[A-Za-z]"), _count(text, "[.]"),
        _count(text, "[ ]"), _count(text, "[-]"), _count(text, "[()]"), _count(text, "@"),
        before.rlike("[\"'=]\\s*$"),
        before.rlike("(?:mail|phone|tel|call|card|ssn|iban)[^a-z]*$"),
        before.rlike(r"\s$|^$"), after.rlike(r"[\s.,;:!?]|^$"), text.rlike("^[0-9]{16}$"),
        _count(text, "[A-Z]"), F.regexp_count(text, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")),
        failed(span),
    ]
    return [F.coalesce(f.cast("double"), F.lit(0.0)) for f in found]


def failed(span: Column) -> Column:
    """Whether a candidate without a base span fails a check, whatever mark it may lack."""
    text, digits = span["text"], _digits(span["text"])
    n = F.length(digits)
    number = (~n.between(8, 19) | (n.between(16, 19) & ~luhn(digits))
              | text.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")  # an IP address with a part over 255
              | text.rlike("^[12][0-9]{3}([-./ ])[01]?[0-9]\\1[0-3]?[0-9](?![0-9])")
              | span["before"].rlike("[A-Za-z_]$") | span["after"].rlike("^[A-Za-z_]"))
    parts = F.split(F.regexp_replace(text, SPELLED, "@"), "@", 2)
    local, host = parts[0], parts[1]
    contact = (local.rlike(r"^\.|\.\.|\.$") | host.rlike(r"^[.-]|\.\.|-\.|\.-")
               | ~local.rlike("[A-Za-z0-9]") | ~host.rlike("[A-Za-z]")
               | (text.rlike(SPELLED) & ~host.rlike(r"\.[A-Za-z0-9]")))
    secret = ~(text.rlike("[0-9]") & text.rlike("[A-Za-z]"))
    return F.coalesce(F.when(span["kind"] == "number", number).when(
        span["kind"] == "contact", contact).otherwise(secret), F.lit(False))


@dataclass(frozen=True)
class Trees:
    """Boosted trees as nested (feature, threshold, left, right) or leaf values, and a threshold."""

    trees: Sequence
    weights: Sequence[float]
    keep_at: float

    def score(self, row: Column) -> Column:
        """The score of an array of features."""
        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            at, limit, left, right = node
            return F.when(row[at] <= limit, walk(left)).otherwise(walk(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            total = total + walk(tree) * weight
        return total


def _unpacked(model: GBTClassificationModel) -> list:
    def walk(node):
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        split = node.split()
        return (split.featureIndex(), float(split.threshold()), walk(node.leftChild()),
                walk(node.rightChild()))

    return [walk(t._java_obj.rootNode()) for t in model.trees]


def training_rows(docs: DataFrame) -> DataFrame:
    """``f0, f1, ..., kind, label, held, n``: all candidates by features and label, with their number.

    ``label`` is null where a candidate is neither personal nor surely not. A third of the documents,
    by a hash of their id (of their text, if they have none), is held out.
    """
    key = F.col("doc_id").cast("long")
    side = F.when(key.isNull(), F.xxhash64("text")).otherwise(F.xxhash64(key))
    rows = docs.select("text", (F.pmod(side, F.lit(3)) == 0).alias("held"))
    known = with_candidates(with_base(rows)).select(
        "held", "base", F.explode("candidates").alias("c"))
    covered = F.exists("base", lambda b: F.least(b["end"], F.col("c.end")) - F.greatest(
        b["start"], F.col("c.start")) >= 0.8 * (F.col("c.end") - F.col("c.start")))
    touched = F.exists("base", lambda b: (b["start"] < F.col("c.end"))
                       & (F.col("c.start") < b["end"]))
    own = features(F.col("c"))
    names = [f"f{i}" for i in range(len(own))]
    introduced = (F.col("c.kind") == "secret") & F.col("c.before").rlike(CREDENTIAL)
    personal = F.when(F.col("c.kind") == "secret", introduced & ~touched).otherwise(covered)
    label = F.when(personal & ~failed(F.col("c")), 1.0).when(~touched & failed(F.col("c")), 0.0)
    table = known.select(
        *[f.alias(n) for f, n in zip(own, names, strict=True)], F.col("c.kind").alias("kind"),
        label.alias("label"), "held")
    return table.groupBy(*table.columns).agg(F.count("*").cast("double").alias("n"))


def train(docs: DataFrame, precision: float = PRECISION) -> dict[str, Trees]:
    """The trees of each generator that has both kinds of candidates in the documents."""
    # Stored, so that the many jobs of boosting know nothing of the patterns' plan: each job would
    # carry its stages and their partitions through the driver.
    grouped = stored(training_rows(docs), "candidates")
    n_rows = grouped.count()
    # Boosting runs many short jobs over these rows, so they lie in few partitions.
    names = [c for c in grouped.columns if c not in ("kind", "label", "held", "n")]
    table = VectorAssembler(inputCols=names, outputCol="x").transform(
        grouped.repartition(max(2, n_rows // ROWS_A_TASK))
    ).select("x", "kind", "label", "held", "n").cache()
    try:
        proven = {r.kind for r in table.filter("label = 1").select("kind").distinct().collect()}
        found = {k: _fitted(table, k, precision, n_rows) for k in GENERATORS if k in proven}
    finally:
        table.unpersist()
    return {k: t for k, t in found.items() if t is not None}


def _classifier(total: float, n_rows: int) -> GBTClassifier:
    """Boosted trees for weighted rows; ``total`` is the sum of their weights.

    With so many bins Spark looks for limits in all rows; with fewer, in a sample of them.
    """
    grows = total >= 2 * LEAST_LEAF
    return GBTClassifier(
        featuresCol="x", labelCol="y", weightCol="n", maxIter=8, maxDepth=4 if grows else 0,
        maxBins=max(32, math.isqrt(n_rows) + 1),
        minWeightFractionPerNode=(LEAST_LEAF - 0.5) / total if grows else 0.0, seed=1)


def _fitted(table: DataFrame, kind: str, precision: float, n_rows: int) -> Trees | None:
    """The trees of one generator; None where nothing can be learned or selected."""
    here = F.col("kind") == kind
    fit = (table.filter(~F.col("held")).withColumn("y", F.when(here, F.col("label")).otherwise(0.0))
           .dropna(subset=["y"]))
    shares = [r.n for r in fit.groupBy("y").agg(F.sum("n").alias("n")).collect()]
    if len(shares) < 2:
        return None
    model = _classifier(sum(shares), n_rows).fit(fit)
    raw = vector_to_array("rawPrediction")[1]
    scored = (model.transform(table.filter(here & F.col("held") & F.col("label").isNotNull()))
              .groupBy(F.round(raw, 9).alias("s"))
              .agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n"))
              .collect())
    keep_at, good, n = float("inf"), 0.0, 0
    for row in sorted(scored, key=lambda r: -r.s):
        good, n = good + row.good, n + row.n
        # A score that no base match has tells nothing of candidates like them.
        if row.good and good >= precision * n:
            keep_at = row.s
    if keep_at == float("inf"):
        return None
    return Trees(_unpacked(model), [float(w) for w in model.treeWeights], keep_at)


def with_spans(docs: DataFrame, trees: dict[str, Trees] | None) -> DataFrame:
    """Adds ``base`` and ``spans``: base spans and the candidates that the trees select."""
    docs = with_base(docs)
    plain = F.transform(F.col("base"), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    if not trees:
        return docs.withColumn("spans", plain)
    docs = with_candidates(docs)
    picked = F.filter(
        F.col("candidates"),
        lambda c: ~F.exists(F.col("base"), lambda b: (b["start"] < c["end"])
                            & (c["start"] < b["end"])))
    # The trees look up a candidate's features; with their expressions in each node, the plan would
    # hold hundreds of copies.
    docs = docs.withColumn("candidates", F.transform(picked, lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
        F.array(*features(c)).alias("features"))))

    def selected(c: Column) -> Column:
        hit = F.lit(False)
        for kind, t in trees.items():
            hit = hit | ((c["kind"] == kind) & (t.score(c["features"]) >= t.keep_at - 1e-6))
        return hit

    chosen = F.filter(F.col("candidates"), selected)
    ranked = F.array_sort(F.transform(chosen, lambda c: F.struct(
        (c["start"] - c["end"]).alias("o"), c["start"].alias("start"), c["kind"].alias("kind"),
        c["end"].alias("end"))))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    added = F.aggregate(ranked, empty, lambda have, c: F.when(
        F.exists(have, lambda h: (h["start"] < c["end"]) & (c["start"] < h["end"])), have)
        .otherwise(F.concat(have, F.array(F.struct(
            c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))))
    return docs.withColumn("spans", F.concat(plain, added)).drop("candidates")


def joined(spans: Column, order: Sequence[str]) -> Column:
    """``kind:start:end`` of each span, by kind as listed, then place."""
    rank = F.transform(spans, lambda s: F.struct(
        F.array_position(F.lit(list(order)), s["kind"]).alias("k"), s["start"].alias("s"),
        s["end"].alias("e"), s["kind"].alias("n")))
    return F.array_join(F.transform(F.array_sort(rank), lambda s: F.concat_ws(
        ":", s["n"], s["s"].cast("string"), s["e"].cast("string"))), ",")


def find(docs: DataFrame, trees: dict[str, Trees] | None = None, learn: bool = True) -> DataFrame:
    """``doc_id, text, base, spans`` of each document; a null text becomes an empty one."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if trees is None and learn:
        trees = train(own)
    return with_spans(own, trees)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        start = F.greatest(s["start"], state["at"])
        gap = F.substring(text, state["at"] + 1, start - state["at"])
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["end"] <= state["at"], state["out"])
            .otherwise(F.concat(state["out"], gap, mark)).alias("out"))

    return F.aggregate(order, first, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def redact(docs: DataFrame, trees: dict[str, Trees] | None = None, learn: bool = True) -> DataFrame:
    """All columns of the documents, with personal data in ``text`` replaced; nulls stay null."""
    if trees is None and learn:
        trees = train(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    rows = docs.select(F.struct("*").alias("row"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    new = F.when(F.col("row.text").isNotNull(), redacted(F.col("text"), F.col("spans")))
    return with_spans(rows, trees).select(
        *[(new if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
