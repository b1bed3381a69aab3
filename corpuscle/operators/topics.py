"""Topic labels from weighted keyword rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.functions.text import fold
from corpuscle.rules.legal import OTHER_TOPIC
from corpuscle.rules.tables import literal_table
from corpuscle.session import cut_lineage


@dataclass(frozen=True)
class Topic:
    """Keywords match whole words of folded text; document terms match anywhere."""

    name: str
    keywords: tuple[str, ...] = ()
    documents: tuple[str, ...] = ()


@dataclass(frozen=True)
class Weights:
    document: int = 4
    title: int = 3
    question: int = 1


def topics_from_rules(rules: DataFrame) -> list[Topic]:
    """Read ``rules(topic, priority, kind, term)``, a configuration that people write.

    The rules become expressions of the plan.
    """
    rows = rules.orderBy("priority", "kind", "term").toLocalIterator()
    found: dict[str, dict[str, list[str]]] = {}
    for row in rows:
        found.setdefault(row["topic"], {"keyword": [], "document": []})[row["kind"]].append(
            row["term"])
    return [Topic(n, tuple(k["keyword"]), tuple(k["document"])) for n, k in found.items()]


def rule_table(spark: SparkSession, topics: Sequence[Topic]) -> DataFrame:
    """``rules(topic, priority, kind, term)`` of topics written in code, in their order."""
    rows = [(t.name, i, kind, term) for i, t in enumerate(topics)
            for kind, terms in (("keyword", t.keywords), ("document", t.documents)) for term in terms]
    return literal_table(spark, rows, "topic STRING, priority INT, kind STRING, term STRING")


TOKEN = "[^a-z0-9]+"


def _index(rules: DataFrame) -> Column:
    """Keywords by the hash of their longest token, one bucket per expected entry.

    The value is a scalar of the plan: rules of any number are data, not plan nodes.
    """
    size = F.greatest(F.lit(1), rules.agg(F.count(F.lit(1))).scalar()).cast("int")
    tokens = F.filter(F.split("term", TOKEN), lambda w: w != "")
    longest = F.array_max(F.transform(tokens, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    keyed = rules.select("priority", "topic", "term", longest.alias("anchor")) \
        .withColumn("bucket", F.pmod(F.xxhash64("anchor"), size).cast("int"))
    lists = keyed.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct(
        "anchor", "term", "priority", "topic", (F.col("term") == F.col("anchor")).alias("whole")))).alias("terms"))
    full = rules.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), size - 1)).alias("bucket")) \
        .join(lists, "bucket", "left")
    return full.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "terms"))),
                                lambda b: F.coalesce(b["terms"], F.expr(
                                    "CAST(array() AS array<struct<anchor:string,term:string,priority:int,"
                                    "topic:string,whole:boolean>>)")))).scalar()


def _keyword_hits(text: str, index: str, weight: int) -> Column:
    """One hit per keyword that stands in the folded text with no letter or digit next to it.

    Every distinct token of the text is looked up by its hash.  A keyword of one token is
    found with it; of a phrase or a term with signs the token is only the anchor, and the
    term is looked for in the text.
    """
    def entries(token: Column) -> Column:
        bucket = F.get(F.col(index), F.pmod(F.xxhash64(token), F.size(index)).cast("int"))
        quoted = lambda r: F.concat(F.lit(r"(?<![a-z0-9])\Q"), r["term"], F.lit(r"\E(?![a-z0-9])"))     # noqa: E731
        return F.filter(bucket, lambda r: (r["anchor"] == token) & (r["whole"] | (
            F.contains(F.col(text), r["term"]) & F.regexp_like(F.col(text), quoted(r)))))

    found = F.flatten(F.transform(F.array_distinct(F.split(text, TOKEN)), entries))
    return F.transform(found, lambda r: F.struct(
        r["priority"].alias("priority"), r["topic"].alias("topic"), F.lit(weight).alias("weight")))


def classify(records: DataFrame, topics: Sequence[Topic] | DataFrame, *, title: Column, question: Column,
             documents: Column, weights: Weights = Weights(),
             other: str = OTHER_TOPIC) -> DataFrame:
    """Add ``topic`` and ``score``; ties go to the earlier topic, no hit to ``other``.

    ``topics`` may be a table ``rules(topic, priority, kind, term)`` of folded terms.  A
    topic has the smallest priority of its rules, repeated rules count once.  The rules
    are brought into an index that travels with the plan as one value, so they are meant
    to be configuration; every record is classified in its row, without a shuffle.
    """
    spark = records.sparkSession
    rules = topics if isinstance(topics, DataFrame) else rule_table(spark, topics)
    first = rules.groupBy("topic").agg(F.min("priority").cast("int").alias("priority"))
    rules = rules.select("topic", "kind", "term").where("topic IS NOT NULL AND term <> ''").distinct().join(first, "topic")
    anchored = F.regexp_like("term", F.lit("[a-z0-9]"))
    index = _index(rules.where((F.col("kind") == "keyword") & anchored))
    named = rules.where("kind = 'document'").agg(F.collect_set(F.struct("priority", "topic", "term"))).scalar()
    folded = records.withColumns({"_t": fold(title), "_q": fold(question), "_d": fold(documents),
                                  "_index": index, "_named": named})
    # A topic counts once for its documents, whichever of them are named.
    by_name = F.array_distinct(F.transform(
        F.filter("_named", lambda r: F.contains(F.col("_d"), r["term"])),
        lambda r: F.struct(r["priority"].alias("priority"), r["topic"].alias("topic"),
                           F.lit(weights.document).alias("weight"))))
    hits = F.concat(by_name, _keyword_hits("_t", "_index", weights.title), _keyword_hits("_q", "_index", weights.question))

    def total(found: Column) -> Column:
        topics_hit = F.array_distinct(F.transform(found, lambda h: F.struct(h["priority"], h["topic"])))
        return F.array_max(F.transform(topics_hit, lambda k: F.struct(
            F.aggregate(F.filter(found, lambda h: (h["priority"] == k["priority"]) & (h["topic"] == k["topic"])),
                        F.lit(0), lambda s, h: s + h["weight"]).alias("score"),
            (-k["priority"]).alias("rank"), k["topic"].alias("topic"))))

    return (folded.withColumn("_b", let(hits, total))
            .withColumns({"topic": F.coalesce(           # never NULL, so joins on it add no filter
                F.when(F.col("_b.score") > 0, F.col("_b.topic")), F.lit(other)),
                "score": F.coalesce("_b.score", F.lit(0))})
            .drop("_t", "_q", "_d", "_index", "_named", "_b"))


def topic_distribution(labelled: DataFrame, sample: str, order: str,
                       samples: int = 3) -> DataFrame:
    """Count, whole percent and the first samples per topic.

    Samples come from a small bounded top-k aggregate, not from collected groups.  The
    labels are written first, three narrow columns, so texts are classified once.
    """
    labelled = cut_lineage(labelled.select(*dict.fromkeys(["topic", sample, order])))
    everything = Window.partitionBy()          # over one row per topic
    counts = (labelled.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("total", F.sum("n").over(everything)))
    firsts = first_k(labelled, ["topic"], order, sample, samples)
    return (counts.join(firsts, "topic", "left")
            .select("topic", "n", F.expr("n * 100 div total").alias("percent"),
                    F.array_join("firsts", " | ").alias("samples")))


def first_k(rows: DataFrame, keys: Sequence[str], order: str, value: str, k: int) -> DataFrame:
    """The first ``k`` values per key in order.

    The rank filter is pushed below the shuffle by the group-limit rule, so at
    most ``k`` rows per key and task are moved.
    """
    window = Window.partitionBy(*keys).orderBy(order)
    ranked = rows.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= k)
    return ranked.groupBy(*keys).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("_rn", F.col(value).alias("v")))),
        lambda e: e["v"]).alias("firsts"))


def relabel(labelled: DataFrame, original: str = "field", section: str = "section") -> DataFrame:
    """The topic replaces the category; the original is kept once, in ``section``."""
    kept = F.col(original) if section not in labelled.columns else F.coalesce(section, original)
    return labelled.withColumn(section, kept).withColumn(original, F.col("topic"))
