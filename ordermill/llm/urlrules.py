"""URL filtering by fixed host and path rules, and by mined association rules.

URLs that a fixed rule judges are the labelled rows. Spark's FP-growth mines which combinations of
URL tokens go with the verdict ``block`` among them. Hosts are dealt in two halves by a hash. A rule is
mined on the first half, where it needs its support, and must hold on the second, which it has not
seen: in both its confidence counts by the lower bound (Wilson, 95 %), so a few rows are no proof, and
neither is one host. Three kinds of tokens take no part. Those that the fixed rules ask for would only
repeat these rules. A host's domain tells something only if it has labelled rows of both verdicts:
where the fixed rules judge nothing but blocks, that is their choice and no evidence. Tokens of nearly
every URL tell nothing.

Tokens of the same rows are one item, and a rule of one item is taken out before longer ones are
mined, so the number of combinations is bounded by the support, not by tokens that always come
together; rules have any length. A rule that a shorter one covers is dropped. URLs without a fixed
rule are blocked if they hold all items of a mined rule. An inverted index, from a rule's rarest item
to the rule, gives each URL the few rules worth testing. The number of mined rules depends on the
support and the token kinds, not on the number of URLs, so the index is a literal of the query, like a
model's weights.

Nulls: a null URL, and one without ``://``, has an empty host and path, no rule and no token; it is
allowed. A URL of any length is read whole. Repeated rows and ids are judged alike. Without labelled
URLs there is no mined rule; an empty table gives an empty result. Other columns of the table are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.95
#: Normal quantile of the one-sided 95 % bound.
QUANTILE = 1.645

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with all its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        inside = (host == self.host) | host.endswith("." + self.host)
        return inside & path.startswith(self.path)


#: The rules of the query on ``pages``.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host domains, path segments, the extension, query keys, a fragment."""
    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    labels = F.filter(F.split(host, r"\."), lambda p: p != "")
    domains = F.transform(labels, lambda _, i: F.array_join(
        F.slice(labels, i + 1, F.size(labels)), "."))
    rest = _rest(url)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^[^=]*", 0))
    extension = F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    fragment = F.array(F.regexp_extract(rest, r"#(.*)", 1))
    return F.array_distinct(F.concat(
        marked("host:", domains), marked("path:", F.split(path, "/")),
        marked("type:", extension), marked("key:", keys), marked("part:", fragment)))


def fixed_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest fitting rule as a struct of its text and verdict, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), value).otherwise(found)
    return found


def prepared(pages: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """``page_id, url, host, path, fixed, tokens`` of each page."""
    url = F.col("url")
    return (pages.select("page_id", url)
            .withColumn("host", F.coalesce(host_of(url), F.lit("")))
            .withColumn("path", F.coalesce(path_of(url), F.lit("")))
            .withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
            .withColumn("tokens", F.coalesce(
                tokens_of(url, F.col("host"), F.col("path")), F.array().cast("array<string>"))))


@dataclass(frozen=True)
class MinedRule:
    """Items of a rule; support and confidence on the first half, precision on the second."""

    tokens: tuple[str, ...]
    support: float
    confidence: float
    held_rows: int
    held_precision: float


@dataclass(frozen=True)
class Mined:
    """Rules, and the item that stands for each token with others of the same rows.

    ``tried`` is the number of rules of the first half that were tested on the second.
    """

    rules: tuple[MinedRule, ...]
    same: dict[str, str]
    tried: int

    def items(self, tokens: Column) -> Column:
        if not self.same:
            return tokens
        table = F.create_map(*[F.lit(v) for pair in sorted(self.same.items()) for v in pair])
        return F.array_distinct(F.transform(
            tokens, lambda t: F.coalesce(F.try_element_at(table, t), t)))


def lower_bound(confidence: Column, n: Column) -> Column:
    """Wilson's lower bound of a share that ``n`` rows show."""
    z = QUANTILE ** 2
    middle = confidence + z / (2 * n)
    spread = QUANTILE * F.sqrt((confidence * (1 - confidence) + z / (4 * n)) / n)
    return (middle - spread) / (1 + z / n)


def wilson(part: int, whole: int) -> float:
    """:func:`lower_bound` of a plain share; 0 of nothing."""
    if not whole:
        return 0.0
    share, z = part / whole, QUANTILE ** 2
    spread = QUANTILE * math.sqrt((share * (1 - share) + z / (4 * whole)) / whole)
    return (share + z / (2 * whole) - spread) / (1 + z / whole)


def constant_tokens(rules: Sequence[UrlRule]) -> set[str]:
    """The tokens that the fixed rules ask for."""
    hosts = {f"host:{r.host}" for r in rules if r.host}
    return hosts | {f"path:{p}" for r in rules for p in r.path.split("/") if p}


def second_half(host: Column) -> Column:
    """Whether a host's rows are kept for testing."""
    return F.substring(F.md5(host), 1, 1) >= "8"


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE, rules: Sequence[UrlRule] = ()) -> Mined:
    """Rules from token combinations to ``block``; ``labelled`` has ``host, tokens, verdict``.

    ``rules`` are the fixed rules that gave the verdicts. What reaches the driver are tokens and
    rules with their support: a number that the support bounds.
    """
    rows = labelled.select("tokens", (F.col("verdict") == "block").alias("bad"),
                           second_half(F.col("host")).alias("held"),
                           F.xxhash64("tokens").alias("row"))
    first, second = F.count_if(~F.col("held")), F.count_if("held")
    total = rows.agg(first.alias("n")).first().n
    if not total:
        return Mined((), {}, 0)
    bad = F.col("bad")
    counts = (rows.select("*", F.explode("tokens").alias("token")).groupBy("token").agg(
        first.alias("n"), F.count_if(bad & ~F.col("held")).alias("bad"),
        second.alias("held"), F.count_if(bad & F.col("held")).alias("held_bad"),
        # Equal for tokens of the same rows.
        F.sum(F.pmod("row", F.lit(1_000_000_007))).alias("sum"), F.bit_xor("row").alias("xor"))
        .filter((F.col("bad") >= math.ceil(min_support * total)) & (F.col("n") < 0.99 * total))
        .orderBy("token").collect())
    known = constant_tokens(rules)
    counts = [r for r in counts if r.token not in known and not (
        r.token.startswith("host:") and r.bad + r.held_bad == r.n + r.held)]
    same: dict[str, str] = {}
    leader: dict[tuple, str] = {}
    for r in counts:
        same[r.token] = leader.setdefault((r.n, r.held, r.sum, r.xor), r.token)
    counts = [r for r in counts if same[r.token] == r.token]

    def sound(bad_rows: int, all_rows: int) -> bool:
        return wilson(bad_rows, all_rows) >= min_confidence

    def rule(tokens: Sequence[str], r) -> MinedRule:
        return MinedRule(tuple(tokens), r.bad / total, r.bad / r.n, r.held, r.held_bad / r.held)

    single = [r for r in counts if sound(r.bad, r.n)]
    kept = [rule([r.token], r) for r in single if sound(r.held_bad, r.held)]
    tried = len(single)
    taken = {t for k in kept for t in k.tokens}
    rest = [r.token for r in counts if r.token not in taken]
    if len(rest) > 1:
        made = Mined((), same, 0)
        items = rows.withColumn("tokens", F.array_intersect(
            made.items(F.col("tokens")), F.lit(rest)))
        train = items.filter(~F.col("held")).select(F.concat(
            "tokens", F.array(F.when(bad, "verdict:block").otherwise("verdict:allow")))
            .alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=min_support,
                         minConfidence=min_confidence).fit(train)
        n = F.round(F.col("support") * total / F.col("confidence"))
        found = (model.associationRules
                 .filter((F.element_at("consequent", 1) == "verdict:block")
                         & ~F.exists("antecedent", lambda t: t.startswith("verdict:"))
                         & (F.size("antecedent") > 1)
                         & (lower_bound(F.col("confidence"), n) >= min_confidence))
                 .select(F.array_sort("antecedent").alias("tokens")).collect())
        longer = sorted((tuple(r.tokens) for r in found), key=lambda t: (len(t), t))
        tried += len(longer)
        tested = _tested(items, longer)
        for tokens, r in zip(longer, tested, strict=True):
            covered = any(set(k.tokens) <= set(tokens) for k in kept)
            if not covered and sound(r.held_bad, r.held):
                kept.append(rule(tokens, r))
    return Mined(tuple(kept), same, tried)


def _tested(items: DataFrame, rules: list[tuple[str, ...]]) -> list:
    """Counts of both halves for each rule, in one pass."""
    if not rules:
        return []
    index = F.array(*[F.array(*[F.lit(t) for t in r]) for r in rules])
    held = F.filter(F.sequence(F.lit(0), F.lit(len(rules) - 1)), lambda i: F.size(
        F.array_except(F.get(index, i), F.col("tokens"))) == 0)
    counts = items.select("bad", "held", F.explode(held).alias("rule")).groupBy("rule").agg(
        F.count_if(~F.col("held")).alias("n"), F.count_if(F.col("bad") & ~F.col("held")).alias("bad"),
        F.count_if("held").alias("held"),
        F.count_if(F.col("bad") & F.col("held")).alias("held_bad")).orderBy("rule")
    return counts.collect()


def matches(tokens: Column, found: Mined) -> Column:
    """Whether a token set holds all items of a rule, by the inverted index."""
    mined, tokens = found.rules, found.items(tokens)
    if not mined:
        return F.lit(False)
    used: dict[str, int] = {}
    for rule in mined:
        for token in rule.tokens:
            used[token] = used.get(token, 0) + 1
    index: dict[str, list[tuple[str, ...]]] = {}
    for rule in mined:
        index.setdefault(min(rule.tokens, key=lambda t: (used[t], t)), []).append(rule.tokens)
    entries = []
    for token, postings in sorted(index.items()):
        entries += [F.lit(token), F.array(*[F.lit(list(p)) for p in postings])]
    table = F.create_map(*entries)
    return F.exists(tokens, lambda token: F.coalesce(F.exists(
        F.try_element_at(table, token),
        lambda rule: F.size(F.array_except(rule, tokens)) == 0), F.lit(False)))


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and whether a mined rule decided."""
    known = prepared(pages, rules)
    labelled = known.filter(F.col("fixed").isNotNull()).select(
        "host", F.col("fixed.verdict").alias("verdict"), "tokens")
    mined = mine(labelled, min_support, min_confidence, rules)
    hit = F.col("fixed").isNull() & matches(F.col("tokens"), mined)
    return known.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce(F.col("fixed.verdict"),
                   F.when(hit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        hit.alias("mined"))
