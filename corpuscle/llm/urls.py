"""URL filters: listed rules first, mined association rules for the rest.

Listed rules fit a host with its subdomains and a path prefix.  The urls they judge
are labels.  FP-growth mines combinations of url tokens that go with a verdict; rules
with enough support and confidence, no better shorter rule and a lift over the share
of the verdict are kept.  Each rule is posted in an inverted index under its rarest
token, urls look up their tokens there, and the most confident rule whose tokens are
all present decides.  DataFrame functions and Spark's FP-growth only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT = 0.005       # share of the labelled urls that a combination must have
CONFIDENCE = 0.9
LIFT = 1.02
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(_rest(url), r"^[^/?#]+", ""), r"^[^?#]*", 0)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it or for a null url."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def listed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, top, prefix in reversed(ordered):
        fits = ((host == top) | host.endswith(f".{top}")) & path.startswith(prefix)
        name = F.when(fits, F.lit(top + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def tokens(host: Column, path: Column, rules=RULES) -> Column:
    """Distinct tokens of host and path.

    Left out are numbers and the words that the listed rules consist of: the labels
    follow from those by definition, so they would only repeat the rules.
    """
    known = sorted({w for _, h, p in rules for w in (*h.split("."), *p.strip("/").split("/")) if w})
    words = F.array_distinct(F.split(F.concat_ws(" ", host, F.translate(path, UPPER, LOWER)), "[^a-z0-9]+"))
    return F.filter(words, lambda w: (w != "") & ~w.rlike("^[0-9]+$") & ~w.isin(known))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE,
         lift: float = LIFT) -> DataFrame:
    """``items``, ``verdict``, ``confidence``, ``support``: pruned rules from ``tokens`` and ``verdict``.

    A rule goes when a rule for the same verdict with fewer tokens, all among its own,
    is at least as confident.  How many item sets there are is bounded by the support.
    """
    spark = labelled.sparkSession
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit("="), F.col("verdict"))).alias("items"))
    if baskets.isEmpty():
        return spark.createDataFrame([], "items ARRAY<STRING>, verdict STRING, confidence DOUBLE, support DOUBLE")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.element_at("consequent", 1).startswith("=")) \
        .where(~F.exists("antecedent", lambda i: i.startswith("="))).where(F.col("lift") >= lift) \
        .select(F.array_sort("antecedent").alias("items"), F.substring(F.element_at("consequent", 1), 2, 99)
                .alias("verdict"), "confidence", "support")
    rules = cut_lineage(rules)
    # A shorter rule is looked up under each of the longer rule's tokens.
    short = rules.select(F.element_at("items", 1).alias("first"), F.col("items").alias("part"),
                         F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    worse = rules.select("*", F.explode("items").alias("item")).join(
        short, (F.col("item") == F.col("first")) & (F.col("verdict") == F.col("v"))
        & (F.size("part") < F.size("items")) & (F.col("c") >= F.col("confidence"))
        & (F.size(F.array_except("part", "items")) == 0)).select("items", "verdict").distinct()
    return rules.join(worse, ["items", "verdict"], "left_anti")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
          support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per input row: ``key``, ``host``, ``path``, ``rule``, ``verdict``, ``evidence``.

    ``rule`` is the listed rule or null; then the verdict is that of the best mined
    rule (highest confidence, then support, then block before allow, then tokens),
    whose tokens are ``evidence``, and allow when none applies.  Null urls and urls
    without ``://`` have an empty host and path.  Repeated rows and keys keep their rows.
    """
    host, path = F.col("host"), F.col("path")
    name, verdict = listed_rule(host, path, rules)
    parsed = pages.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
                          host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")) \
        .withColumn("rule", name).withColumn("listed", verdict).withColumn("tokens", tokens(host, path, rules))
    parsed = cut_lineage(parsed)      # fixed row numbers; urls only, no page bodies
    labelled = parsed.where(F.col("listed").isNotNull()).select("tokens", F.col("listed").alias("verdict"))
    mined = mine(labelled, support, confidence)
    seen = labelled.select(F.explode("tokens").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    # The index: every rule under the token of it that the fewest labelled urls have.
    index = mined.select("*", F.explode("items").alias("item")).join(seen, "item") \
        .groupBy("items", "verdict", "confidence", "support").agg(F.min_by("item", F.struct("n", "item")).alias("item"))
    index = cut_lineage(index)        # its size is known from here on, so Spark may broadcast it or not
    hits = parsed.where(F.col("listed").isNull()).select("row", "tokens", F.explode("tokens").alias("item")) \
        .join(index, "item").where(F.size(F.array_except("items", "tokens")) == 0)
    best = hits.groupBy("row").agg(F.min(F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"),
        (F.col("verdict") != "block").alias("a"), "items", "verdict")).alias("best"))
    return parsed.join(best, "row", "left").select(
        F.col("key").alias(key), "host", "path", "rule",
        F.coalesce("listed", F.col("best.verdict"), F.lit("allow")).alias("verdict"),
        F.array_join("best.items", " ").alias("evidence"))


