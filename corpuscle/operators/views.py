"""Read views over the star schema and the path catalogue.

Dimensions are joined without hints: AQE broadcasts a side only when its size
at run time is below the session threshold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNASSIGNED = "(unassigned)"


# ---------------------------------------------------------------- star schema

def question_view(question: DataFrame, source: DataFrame, topic: DataFrame) -> DataFrame:
    """Questions with source and topic names; a missing topic stays NULL."""
    return (question
            .join(source.select("source_id", F.col("name").alias("source")), "source_id")
            .join(topic.select("topic_id", F.col("name").alias("topic")), "topic_id", "left")
            .select("question_id", "source", "topic", "posted_at", "title", "question",
                    "answer", "url"))


def citation_view(citation: DataFrame, question: DataFrame, topic: DataFrame,
                  document: DataFrame) -> DataFrame:
    """Citations with question, topic and document columns."""
    return (citation
            .join(question.select("question_id", "topic_id", "title"), "question_id")
            .join(topic.select("topic_id", F.col("name").alias("topic")), "topic_id", "left")
            .join(document.select("document_id", "number", F.col("name").alias("document"),
                                  "type"), "document_id", "left")
            .select("question_id", "topic", "title", "number", "document", "type",
                    "article", "clause", "point"))


def popular_documents(citation: DataFrame, document: DataFrame) -> DataFrame:
    """Citations and citing questions per document, most cited first.

    Counted on the narrow key before the dimension is joined, so the join sees
    one row per document.
    """
    counts = (citation.where(F.col("document_id").isNotNull())
              .groupBy("document_id")
              .agg(F.count(F.lit(1)).alias("citations"),
                   F.count_distinct("question_id").alias("questions")))
    return (counts.join(document.select("document_id", "number", "name", "type"), "document_id")
            .orderBy(F.desc("citations"), "document_id"))


def answer_progress(question: DataFrame, topic: DataFrame) -> DataFrame:
    """Answered and unanswered questions and the last answer time per topic."""
    per_topic = question.groupBy("topic_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("ai_answer").alias("answered"),
        F.max("ai_updated").alias("last_answer"))
    return _by_topic_name(per_topic, topic).groupBy("topic").agg(
        F.sum("total").alias("total"), F.sum("answered").alias("answered"),
        (F.sum("total") - F.sum("answered")).alias("unanswered"),
        F.max("last_answer").alias("last_answer"))


def _by_topic_name(per_topic: DataFrame, topic: DataFrame) -> DataFrame:
    return (per_topic.join(topic.select("topic_id", F.col("name").alias("topic")),
                           "topic_id", "left")
            .withColumn("topic", F.coalesce("topic", F.lit(UNASSIGNED))))


def grade_summary(question: DataFrame, topic: DataFrame,
                  verdicts: tuple[str, ...] = ("match", "partial", "contrary", "no_answer"),
                  ) -> DataFrame:
    """Graded questions, one count per verdict and mean scores to one decimal, per topic."""
    graded = question.select(
        "topic_id", "ai_answer", "ai_grade",
        F.get_json_object("ai_grade", "$.verdict").alias("verdict"),
        *[F.get_json_object("ai_grade", f"$.{s}").cast("decimal(9,3)").alias(s)
          for s in ("content_score", "basis_score")])
    scores = ("content_score", "basis_score")
    per_topic = graded.groupBy("topic_id").agg(
        F.count(F.lit(1)).alias("total"), F.count("ai_answer").alias("answered"),
        F.count("ai_grade").alias("graded"),
        *[F.count_if(F.col("verdict") == v).alias(v) for v in verdicts],
        *[F.sum(s).alias(f"{s}_sum") for s in scores],
        *[F.count(s).alias(f"{s}_n") for s in scores])
    counts = ("total", "answered", "graded", *verdicts)
    return _by_topic_name(per_topic, topic).groupBy("topic").agg(
        *[F.sum(c).alias(c) for c in counts],
        *[F.round(F.sum(f"{s}_sum") / F.nullif(F.sum(f"{s}_n"), F.lit(0)), 1)
          .cast("double").alias(f"mean_{s}") for s in scores])


# ---------------------------------------------------------------- catalogue

@dataclass(frozen=True)
class RowKinds:
    """Rules that tell real items from group, continuation and remark rows.

    The defaults are fixed values of the legal catalogues.
    """

    continuation: str = r"(?iu)^(và|and)\s"
    remark: str = r"(?U)^(Ví dụ|Ngoại trừ)\b"
    group_mark: str = "Bảng B"
    classes: dict[str, list[str]] = field(default_factory=lambda: {
        "Đặc biệt nặng nhọc, độc hại, nguy hiểm": ["Loại V", "Loại VI"],
        "Nặng nhọc, độc hại, nguy hiểm": ["Loại IV"],
    })

    def is_group(self) -> Column:
        level_2 = F.try_element_at("path", F.lit(2))
        return F.coalesce(level_2.contains(self.group_mark) & F.col("codes").isNull()
                          & F.col("formula").isNull(), F.lit(False))

    def kind(self) -> Column:
        def starts(col: str, pattern: str) -> Column:
            return F.coalesce(F.col(col).rlike(pattern), F.lit(False))

        return (F.when(starts("name", self.continuation)
                       | starts("other_name", self.continuation), "continuation")
                .when(starts("name", self.remark), "remark")
                .when(self.is_group(), "group")
                .otherwise("item"))

    def item_class(self) -> Column:
        out = F.lit(None).cast("string")
        for label, marks in reversed(list(self.classes.items())):
            out = F.when(F.arrays_overlap("path", F.array(*map(F.lit, marks))),
                         F.lit(label)).otherwise(out)
        return out


PATH_SEPARATOR = " › "


def catalogue_view(item: DataFrame, catalogue: DataFrame, document: DataFrame,
                   rules: RowKinds = RowKinds()) -> DataFrame:
    """Items with catalogue and document columns, joined path, row kind, label and class."""
    parents = catalogue.select("catalogue_id", F.col("code").alias("catalogue"), "short_name",
                               "name_label", "group_label")
    docs = document.select("document_id", F.col("name").alias("document_name"),
                           F.col("link").alias("document_link"))
    return (item.join(parents, "catalogue_id").join(docs, "document_id", "left")
            .select(
                "item_id", "catalogue", "short_name", "document", "document_id",
                "document_name", "document_link", "path",
                F.array_join("path", PATH_SEPARATOR).alias("place"),
                F.try_element_at("path", F.lit(1)).alias("level_1"),
                F.try_element_at("path", F.lit(2)).alias("level_2"),
                rules.kind().alias("kind"), "ordinal", "name", "other_name", "codes",
                F.when(rules.is_group(), F.coalesce("group_label", "name_label"))
                .otherwise(F.col("name_label")).alias("label"),
                "formula", "threshold", "description", rules.item_class().alias("item_class")))


def level_view(item: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per path level with the label its catalogue declares for it."""
    parents = catalogue.select("catalogue_id", F.col("code").alias("catalogue"), "level_labels")
    return (item.select("item_id", "catalogue_id", "name", F.posexplode("path").alias("i", "value"))
            .join(parents, "catalogue_id")
            .select("item_id", "catalogue", "name", (F.col("i") + 1).alias("level"),
                    F.try_element_at("level_labels", F.col("i") + 1).alias("label"), "value"))


def foreign_documents(item: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Documents named by items that the parent catalogue does not list."""
    counts = (item.where(F.col("document").isNotNull())
              .groupBy("catalogue_id", "document").agg(F.count(F.lit(1)).alias("rows")))
    return (counts.join(catalogue.select("catalogue_id", "code", "documents"), "catalogue_id")
            .where(~F.array_contains("documents", F.col("document")))
            .groupBy("code", "document").agg(F.sum("rows").alias("rows")))


def missing_labels(item: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Paths deeper than the labels their catalogue declares."""
    counts = (item.select("catalogue_id", F.size("path").alias("levels"))
              .groupBy("catalogue_id", "levels").agg(F.count(F.lit(1)).alias("rows")))
    return (counts.join(catalogue.select("catalogue_id", "code",
                                         F.size("level_labels").alias("labels")), "catalogue_id")
            .where(F.col("levels") > F.coalesce("labels", F.lit(0)))
            .groupBy("code", "levels", "labels").agg(F.sum("rows").alias("rows")))


def unresolved_documents(item: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Items that name a document which has no id."""
    counts = (item.where(F.col("document").isNotNull() & F.col("document_id").isNull())
              .groupBy("catalogue_id", "document").agg(F.count(F.lit(1)).alias("rows")))
    return (counts.join(catalogue.select("catalogue_id", "code"), "catalogue_id")
            .groupBy("code", "document").agg(F.sum("rows").alias("rows")))


def document_coverage(view: DataFrame, question_document: DataFrame) -> DataFrame:
    """Per catalogue document: real items, rows, and distinct questions citing it."""
    asked = question_document.groupBy("document_id").agg(
        F.count_distinct("question_id").alias("questions"))
    rows = view.groupBy("catalogue", "document", "document_id", "document_name",
                        "document_link").agg(
        F.count_if(F.col("kind") == "item").alias("items"), F.count(F.lit(1)).alias("rows"))
    return (rows.join(asked, "document_id", "left")
            .withColumn("questions", F.coalesce("questions", F.lit(0).cast("bigint"))))


def kind_counts(view: DataFrame) -> DataFrame:
    return view.groupBy("catalogue", "document", "kind").agg(F.count(F.lit(1)).alias("rows"))


def flat_catalogue_view(item: DataFrame, document: DataFrame) -> DataFrame:
    """Flat catalogue rows with the document's number, falling back to the row's own."""
    docs = document.select("document_id", F.col("number").alias("_number"),
                           F.col("name").alias("document_name"), F.col("type").alias("doc_type"))
    return (item.join(docs, "document_id", "left")
            .withColumn("number", F.coalesce("_number", "number")).drop("_number"))


def question_catalogue(question: DataFrame, question_document: DataFrame,
                       document: DataFrame, item: DataFrame) -> DataFrame:
    """Per question and document: catalogue items reachable through the document.

    Items are counted per document and catalogue first, so a document with very
    many items adds one row to the join instead of all its items.  Links of documents
    without items are dropped before links are counted.
    """
    per_document = item.where(F.col("document_id").isNotNull()).groupBy(
        "document_id", "catalogue_id").agg(F.count(F.lit(1)).alias("n"))
    listed = question_document.join(per_document.select("document_id"), "document_id", "left_semi")
    links = listed.groupBy("question_id", "document_id").agg(F.count(F.lit(1)).alias("links"))
    docs = document.select("document_id", "number", F.col("name").alias("document"))
    return (links.join(per_document, "document_id").join(docs, "document_id")
            .join(question.select("question_id", "title"), "question_id")
            .groupBy("question_id", "title", "number", "document", "catalogue_id")
            .agg(F.sum(F.col("n") * F.col("links")).alias("items")))


def items_per_question(question: DataFrame, question_document: DataFrame,
                       document: DataFrame, item: DataFrame,
                       catalogue: DataFrame) -> DataFrame:
    """Question -> document -> item -> catalogue, items per question and catalogue."""
    rows = question_catalogue(question, question_document, document, item)
    return (rows.join(catalogue.select("catalogue_id", F.col("short_name").alias("catalogue")),
                      "catalogue_id")
            .groupBy("question_id", "title", "document", "catalogue")
            .agg(F.sum("items").alias("items")))
