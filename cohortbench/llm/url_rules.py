"""URL verdicts: a curated rule list, and association rules mined from labelled URLs.

Spark's FP-growth finds the combinations of URL tokens that go with the label ``block``. Rules are
pruned by support, confidence and redundancy, and matched through an inverted index: each rule is
filed under its rarest token, and only URLs with that token are held against the whole rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.llm.common import settled

BLOCK, ALLOW = "block", "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "label:block"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and how its paths begin, written as ``host/path``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


@dataclass(frozen=True)
class Mining:
    """Bounds of the mined rules; min_support is a share of the labelled URLs.

    widest: items of a labelled URL up to which FP-growth may list all its frequent sets.
    """

    min_support: float = 0.01
    min_confidence: float = 0.8
    max_tokens: int = 3
    widest: int = 14


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        on_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = on_host & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens: scheme, top domain, host labels and their words, directories, ending,
    query keys, fragment. Numbers count as ``#``, so that a rule can't be about one page."""
    plain = F.coalesce(url, F.lit(""))

    def tagged(tag: str, parts: Column) -> Column:
        parts = F.filter(parts, lambda p: p != "")
        return F.transform(parts, lambda p: F.concat(F.lit(tag), F.regexp_replace(p, "[0-9]+", "#")))

    labels = F.split(host, r"\.")
    steps = F.split(path, "/")
    folders = F.slice(steps, F.lit(1), F.greatest(F.size(steps) - 1, F.lit(0)))
    query = F.regexp_extract(plain, r"(?s)\?([^#]*)", 1)
    return F.array_sort(F.array_distinct(F.concat(
        tagged("scheme:", F.array(F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))),
        tagged("top:", F.array(F.element_at(labels, -1))),
        tagged("host:", F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0)))),
        tagged("word:", F.flatten(F.transform(F.filter(labels, lambda p: F.contains(p, F.lit("-"))),
                                              lambda p: F.split(p, "-")))),
        tagged("folder:", folders),
        tagged("ending:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1))),
        tagged("key:", F.transform(F.split(query, "&"), lambda p: F.split(p, "=")[0])),
        tagged("mark:", F.array(F.when(F.contains(plain, F.lit("#")), F.lit("yes")).otherwise(F.lit("")))),
    )))


def token_classes(labelled: DataFrame) -> DataFrame:
    """token, item: tokens that occur in exactly the same rows of ``labelled`` (tokens) are one item, the least of them.

    A template of many query keys is one item so, and not all combinations of its keys. Rows are compared
    by 128 bits of hashes added up over them.
    """
    placed = labelled.select(F.monotonically_increasing_id().alias("row"), "tokens")
    each = placed.select("row", F.explode("tokens").alias("token"))
    first, second = F.xxhash64("row"), F.xxhash64("row", F.lit("second"))
    seen = each.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(first).alias("h1"), F.bit_xor(second).alias("h2"))
    items = seen.groupBy("n", "h1", "h2").agg(F.min("token").alias("item"))
    return seen.join(items, ["n", "h1", "h2"]).select("token", "item")


def as_items(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` (key, tokens) with items: the sorted items of their tokens; tokens of no class have none."""
    each = rows.select("key", F.explode("tokens").alias("token")).join(classes, "token")
    items = each.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return rows.join(items, "key", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))


def frequent_sets(rows: DataFrame, least: int, longest: int, widest: int) -> DataFrame:
    """items, freq: sorted sets of items in at least ``least`` rows (items), up to ``longest`` items where sets may grow long.

    FP-growth lists every frequent set, up to two to the power of a row's items, and has no bound on their
    length. Where rows have more than ``widest`` items, Spark's other pattern growth, which has one, mines
    the same sets as sequences of a single step.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("items")).alias("widest")).first()
    if size["n"] < least:
        return rows.sparkSession.createDataFrame([], "items array<string>, freq long")
    support = (least - 0.5) / size["n"]
    if size["widest"] <= widest:
        return FPGrowth(itemsCol="items", minSupport=support).fit(rows.select("items")).freqItemsets.select(
            F.array_sort("items").alias("items"), "freq")
    steps = rows.select(F.array("items").alias("sequence"))
    found = PrefixSpan(minSupport=support, maxPatternLength=longest, sequenceCol="sequence").findFrequentSequentialPatterns(steps)
    return found.where(F.size("sequence") == 1).select(F.array_sort(F.col("sequence")[0]).alias("items"), "freq")


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """rule_id, tokens, rarest, confidence, support of the kept rules of ``labelled`` (tokens, block).

    A rule goes if one of its parts alone is at least as confident. Tokens that are not frequent together
    with the label can be in no rule and are left out first. No labelled rows or no label ``block`` gives
    no rules; rows without tokens don't count; repeated rows do.
    """
    spark = labelled.sparkSession
    shape = "rule_id long, tokens array<string>, rarest string, confidence double, support double"
    rows = labelled.where(F.size("tokens") > 0).select(F.monotonically_increasing_id().alias("key"), "tokens", "block")
    rows = settled(rows)
    n = rows.count()
    least = max(1, math.ceil(mining.min_support * n))
    blamed = rows.where("block").select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("bad"))
    kept = blamed.where(F.col("bad") >= least).select("token", F.col("token").alias("item"))
    items = as_items(rows, kept).select(F.when(
        F.col("block"), F.concat("items", F.array(F.lit(LABEL)))).otherwise(F.col("items")).alias("items"))
    if not n:
        return spark.createDataFrame([], shape)
    sets = settled(frequent_sets(items.where(F.size("items") > 0), least, mining.max_tokens + 1, mining.widest))
    whole = sets.where(~F.array_contains("items", LABEL)).select(F.col("items").alias("tokens"), "freq")
    bad = sets.where(F.array_contains("items", LABEL)).select(F.array_remove("items", LABEL).alias("tokens"), F.col("freq").alias("bad"))
    rules = bad.where(F.size("tokens").between(1, mining.max_tokens)).join(whole, "tokens").select(
        "tokens", (F.col("bad") / F.col("freq")).alias("confidence"), (F.col("bad") / F.lit(n)).alias("support"))
    rules = rules.where(F.col("confidence") >= mining.min_confidence).withColumn("rule_id", F.xxhash64("tokens"))
    parts = rules.select("rule_id", F.col("confidence").alias("whole"), F.explode("tokens").alias("token"))
    single = rules.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("token"), "confidence")
    shadowed = parts.join(single, "token").where("confidence >= whole").join(
        rules.where(F.size("tokens") > 1).select("rule_id"), "rule_id", "left_semi").select("rule_id").distinct()
    counts = whole.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("token"), "freq")
    rarest = parts.join(counts, "token").groupBy("rule_id").agg(F.min(F.struct("freq", "token")).alias("r"))
    return rules.join(shadowed, "rule_id", "left_anti").join(rarest, "rule_id").select(
        "rule_id", "tokens", F.col("r.token").alias("rarest"), "confidence", "support")


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """key, mined (text of the most confident rule that fits), confidence of the sets (key, tokens) that a rule fits."""
    filed = rules.select("rarest", F.col("tokens").alias("needs"), "confidence", "support")
    asked = token_sets.select("key", "tokens", F.explode("tokens").alias("rarest"))
    hits = asked.join(filed, "rarest").where(F.size(F.array_except("needs", "tokens")) == 0)
    best = hits.groupBy("key").agg(
        F.max(F.struct("confidence", "support", F.array_join("needs", " ").alias("text"))).alias("best"))
    return best.select("key", F.col("best.text").alias("mined"), F.col("best.confidence").alias("confidence"))


def judge(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None,
          mining: Mining = Mining()) -> DataFrame:
    """page_id, host, path, rule, verdict, mined, confidence of every page.

    The longest listed rule decides; else a mined rule blocks; else the page is allowed. Rules are
    mined from every page that ``labels`` (page_id, block) marks, a page_id marked both ways counting as
    blocked, and from every other page that the list decides, as the list decides it. Tokens that
    the labelled pages always show together are one item: a page has it by any of them. An absent URL, or
    one without ``://``, has an empty host and path, no tokens, and is allowed. Long URLs have all their
    tokens. Repeated rows are judged alike. An empty table gives an empty result.
    """
    url = F.col("url").cast("string")
    host, path = host_of(url), path_of(url)
    base = pages.select("page_id", url.alias("url"), host.alias("host"), path.alias("path"))
    rule, listed = listed_rule(F.col("host"), F.col("path"), rules)
    tokens = F.when(F.col("host") != "", url_tokens(F.col("url"), F.col("host"), F.col("path")))
    base = base.select("page_id", "host", "path", rule.alias("rule"), listed.alias("listed"),
                       F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    if labels is None:
        marked = base.withColumn("block", F.col("listed") == BLOCK)
    else:
        one = labels.where("page_id is not null").groupBy("page_id").agg(F.max("block").alias("block"))
        marked = base.join(one, "page_id", "left").withColumn("block", F.coalesce("block", F.col("listed") == BLOCK))
    labelled = settled(marked.where("block is not null").select(F.monotonically_increasing_id().alias("key"), "tokens", "block"))
    classes = settled(token_classes(labelled))
    mined = settled(mine(as_items(labelled, classes).select(F.col("items").alias("tokens"), "block"), mining))
    asked = base.where("listed is null").select(F.col("tokens").alias("key"), "tokens").distinct()
    found = match(as_items(asked, classes).select("key", F.col("items").alias("tokens")), mined)
    return base.join(found.withColumnRenamed("key", "tokens"), "tokens", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("listed", F.when(F.col("mined").isNotNull(), BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("mined")).alias("mined"),
        F.when(F.col("listed").isNull(), F.col("confidence")).alias("confidence"))
