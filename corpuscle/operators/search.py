"""Search, facets and page-sized results.

Optional arguments that are not given add nothing to the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.spans import literal_spans
from corpuscle.functions.text import fold, fold_chars


def any_like(columns: Sequence[str], text: str) -> Column:
    """Case-insensitive infix search; ``%`` and ``_`` in the text stay wildcards."""
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.col(name).ilike(f"%{text}%"), F.lit(False))
    return hit


def search_questions(question: DataFrame, source: DataFrame, topic: DataFrame, *,
                     source_code: str | None = None, topic_name: str | None = None,
                     text: str | None = None, limit: int = 0) -> DataFrame:
    """Questions by source, topic and text, newest first (undated last); limit 0 is all."""
    rows = question
    if text:
        rows = rows.where(any_like(("title", "question", "answer"), text))
    sources = source.select("source_id", F.col("code").alias("source_code"))
    if source_code:
        sources = sources.where(F.col("source_code") == source_code)
    rows = rows.join(sources, "source_id")
    topics = topic.select("topic_id", F.col("name").alias("topic"))
    if topic_name:
        rows = rows.join(topics.where(F.col("topic") == topic_name), "topic_id")
    else:
        rows = rows.join(topics, "topic_id", "left")
    rows = rows.orderBy(F.desc_nulls_last("posted_at"), "question_id")
    return rows.limit(limit) if limit > 0 else rows


def statistics(question: DataFrame, source: DataFrame, topic: DataFrame,
               ranking: DataFrame, top: int = 25) -> dict[str, DataFrame]:
    """Total, questions per topic and per source, and the most cited documents."""
    def per(dim: DataFrame, key: str) -> DataFrame:
        counts = question.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return (counts.join(dim.select(key, "name"), key)
                .groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name"))

    return {
        "total": question.agg(F.count(F.lit(1)).alias("n")),
        "topics": per(topic, "topic_id"),
        "sources": per(source, "source_id"),
        "documents": ranking.orderBy(F.desc("citations"), "document_id").limit(top),
    }


def facets(item: DataFrame, catalogue: DataFrame) -> dict[str, DataFrame]:
    """Rows per catalogue, per document and per first path level (in order of appearance)."""
    codes = catalogue.select("catalogue_id", F.col("code").alias("catalogue"))

    def counted(value: Column) -> DataFrame:
        counts = item.groupBy("catalogue_id", value.alias("value")).agg(
            F.count(F.lit(1)).alias("n"), F.min("item_id").alias("first_item"))
        return counts.join(codes, "catalogue_id").select("catalogue", "value", "n", "first_item")

    return {
        "catalogue": counted(F.lit(None).cast("string")).orderBy("catalogue"),
        "document": counted(F.col("document")).orderBy("catalogue", "value"),
        "level_1": counted(F.try_element_at("path", F.lit(1))).orderBy("catalogue", "first_item"),
    }


def search_catalogue(view: DataFrame, *, catalogue: str | None = None,
                     document: str | None = None, level_1: str | None = None,
                     code: str | None = None, text: str | None = None,
                     limit: int = 0) -> DataFrame:
    """Catalogue rows by equality filters, one exact code, and text in three columns."""
    rows = view
    if catalogue:
        rows = rows.where(F.col("catalogue") == catalogue)
    if document:
        rows = rows.where(F.col("document") == document)
    if level_1:
        rows = rows.where(F.col("level_1") == level_1)
    if code:
        rows = rows.where(F.array_contains(F.split("codes", "; "), code.strip()))
    if text:
        rows = rows.where(any_like(("name", "other_name", "description"), text))
    rows = rows.orderBy("item_id")
    return rows.limit(limit) if limit > 0 else rows


def with_search_text(df: DataFrame, columns: Sequence[str], name: str = "search") -> DataFrame:
    """Folded text of several columns, to be stored once and searched often."""
    return df.withColumn(name, fold(F.concat_ws(" ", *columns)))


def fold_search(df: DataFrame, needle: str, column: str = "search") -> DataFrame:
    """Accent- and case-insensitive infix search on a folded column."""
    return df.where(F.contains(F.col(column), fold(F.lit(needle))))


def hit_positions(text: Column, needle: str) -> Column:
    """0-based positions of all non-overlapping accent-insensitive hits."""
    return literal_spans(fold_chars(text), fold_chars(F.lit(needle)))


def filter_list(df: DataFrame, *, field: str | None = None, document: str | None = None,
                article: str | None = None, text: str | None = None) -> DataFrame:
    """Rows by field, document, article and lower-cased text in title, question, basis."""
    rows = df
    for name, value in (("field", field), ("document", document), ("article", article)):
        if value:
            rows = rows.where(F.col(name) == value)
    if text:
        needle = text.strip().lower()
        rows = rows.where(
            F.coalesce(F.contains(F.lower("title"), F.lit(needle)), F.lit(False))
            | F.coalesce(F.contains(F.lower("question"), F.lit(needle)), F.lit(False))
            | F.coalesce(F.contains(F.lower("basis"), F.lit(needle)), F.lit(False)))
    return rows


def first_page(rows: DataFrame, order: Sequence[Column | str], size: int = 200) -> DataFrame:
    """The first ``size`` rows with the total row count attached."""
    total = rows.agg(F.count(F.lit(1)))
    return rows.orderBy(*order).limit(size).withColumn("total", total.scalar())


def article_histogram(rows: DataFrame) -> DataFrame:
    """Per document: rows, and a text of its articles with counts in numeric order.

    Rows are counted per (document, article) first; what is collected is one
    element per distinct article of a document.
    """
    per_article = rows.groupBy("document", "article").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.coalesce(F.regexp_extract("article", r"^\d+", 0).try_cast("int"),
                                F.lit(0)).alias("number"),
                     F.col("article"), F.col("n"))
    grouped = per_article.groupBy("document").agg(
        F.sum("n").alias("rows"),
        F.array_sort(F.collect_list(F.when(F.col("article") != "", entry))).alias("articles"))
    return grouped.select("document", "rows", F.array_join(
        F.transform("articles", lambda e: F.concat_ws("·", e["article"], e["n"])),
        " , ").alias("articles"))


def document_articles(rows: DataFrame, document: str | None = None) -> DataFrame:
    """Distinct articles of the chosen document, numeric order then text order."""
    picked = rows.where(F.col("document") == document) if document else rows
    number = F.coalesce(F.regexp_extract("article", r"^\d+", 0).try_cast("int"), F.lit(0))
    return (picked.where(F.col("article") != "").select("article").distinct()
            .withColumn("number", number).orderBy("number", "article"))


def facet_values(rows: DataFrame, column: str) -> DataFrame:
    """Values with counts, most frequent first."""
    return (rows.where(F.col(column) != "").groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value"))


def visible_columns(rows: DataFrame, optional: Sequence[str], path: str = "path",
                    label: str = "label") -> DataFrame:
    """One row: which optional columns hold any value, the deepest level, the label if unique."""
    return rows.agg(
        *[F.coalesce(F.bool_or(F.trim(F.col(c)) != ""), F.lit(False)).alias(f"has_{c}")
          for c in optional],
        F.max(F.size(path)).alias("levels"),
        F.when(F.min(label) == F.max(label), F.min(label)).alias("single_label"))


def keyset_page(rows: DataFrame, key: str, after=None, size: int = 200) -> DataFrame:
    """The next ``size`` rows behind a key; the scan is pruned by the key filter."""
    if after is not None:
        rows = rows.where(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def grouped_pages(rows: DataFrame, keys: Sequence[str], item: Column, position: str,
                  class_column: str, classes: Sequence[str], chunk: Column) -> DataFrame:
    """Items as arrays per group, with class tallies, in chunks of bounded size.

    ``chunk`` is a monotone expression of the position (for example ``id div
    1000``), so a very large group becomes several rows instead of one array.
    """
    return rows.groupBy(*keys, chunk.alias("chunk")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(position), item.alias("item")))),
                    lambda e: e["item"]).alias("items"),
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(class_column) == c).alias(f"n_{c}") for c in classes],
        F.min(position).alias("first_position"))
