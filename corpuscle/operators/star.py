"""Idempotent load of the star schema, and its maintenance.

Every function returns a new version of a table; nothing is updated in place,
so a load that is run again (or a task that is retried) gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.text import (empty_to_null, joined_hash, parse_posted, slug, strip,
                                      text_or_empty)
from corpuscle.operators.merge import FILL, KEEP, REPLACE, insert_missing, merge, replace_children
from corpuscle.operators.names import document_key, document_type
from corpuscle.operators.ordered import carry_last, first_rows, row_numbers
from corpuscle.rules import legal
from corpuscle.rules.tables import literal_table

# ---------------------------------------------------------------- dimensions


def source_columns(records: DataFrame, source: str,
                   known: Sequence[tuple[str, str, str, str]] = tuple(legal.SOURCES)) -> DataFrame:
    """Add source code, full name and site; unknown sources get a slug code."""
    table = literal_table(records.sparkSession, known,
                          "_s STRING, _code STRING, _name STRING, _site STRING")
    text = text_or_empty(F.col(source))
    return (records.join(table, text == F.col("_s"), "left")
            .withColumns({
                "source_code": F.coalesce("_code", slug(F.col(source), "khac")),
                "source_name": F.coalesce("_name", empty_to_null(text),
                                          F.lit(legal.OTHER_TOPIC)),
                "source_site": F.coalesce("_site", F.lit(""))})
            .drop("_s", "_code", "_name", "_site"))


def source_dimension(records: DataFrame, order: str) -> DataFrame:
    """One row per source code; the last spelling of the name counts."""
    return records.groupBy(F.col("source_code").alias("code")).agg(
        F.max_by("source_name", order).alias("name"),
        empty_to_null(F.max_by("source_site", order)).alias("website"))


def merge_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    return merge(old, new, ["code"], {"name": REPLACE, "website": KEEP})


def topic_name(topic: Column, other: str = legal.OTHER_TOPIC) -> Column:
    return F.coalesce(empty_to_null(strip(text_or_empty(topic))), F.lit(other))


def merge_topics(old: DataFrame, names: DataFrame) -> DataFrame:
    """Topics not there yet are added; the dimension holds ``name``."""
    return insert_missing(old, names.select("name").distinct(), ["name"])


def document_dimension(mentions: DataFrame, position: Sequence[str],
                       number_pattern: str | None = None) -> DataFrame:
    """Mentions (name, number, link) -> one row per key, first name, first filled fields.

    Mentions are reduced to distinct spellings first, so the key is computed
    once per spelling and little is shuffled.
    """
    order = F.struct(*position)
    linked = F.when(empty_to_null(F.col("link")).isNotNull(), order)
    spellings = (mentions.where(text_or_empty(F.col("name")) != "").groupBy("name", "number")
                 .agg(F.min(order).alias("place"), F.min_by("link", linked).alias("link"),
                      F.min(linked).alias("link_place")))
    keyed = spellings.withColumn(
        "key", document_key(F.col("name"), F.col("number"), number_pattern))
    numbered = F.when(empty_to_null(F.col("number")).isNotNull(), F.col("place"))
    return keyed.groupBy("key").agg(
        F.min_by("name", "place").alias("name"), F.min_by("number", numbered).alias("number"),
        F.min_by("link", "link_place").alias("link")).withColumn(
        "type", document_type(F.col("name")))


def merge_documents(old: DataFrame, new: DataFrame) -> DataFrame:
    """Existing names stay; missing numbers and links are filled in."""
    return merge(old, new, ["key"], {"name": KEEP, "type": KEEP, "number": FILL, "link": FILL})


def assign_ids(dimension: DataFrame, key: str, id_column: str) -> DataFrame:
    """Give rows without an id the next numbers in key order, behind the current maximum.

    The rows are numbered in ranges of the key; only the sizes of the ranges are summed
    in one place.
    """
    has_id = dimension.where(F.col(id_column).isNotNull())
    fresh = dimension.where(F.col(id_column).isNull()).drop(id_column)
    top = has_id.agg(F.coalesce(F.max(id_column).cast("bigint"), F.lit(0).cast("bigint")))
    numbered = (row_numbers(fresh, [], [key], "_rn")
                .withColumn(id_column, top.scalar() + F.col("_rn")).drop("_rn"))
    return (has_id.withColumn(id_column, F.col(id_column).cast("bigint"))
            .unionByName(numbered.select(*dimension.columns)))


# ---------------------------------------------------------------- facts and bridges

def content_hash(source: Column | str, title: Column | str, question: Column | str) -> Column:
    return joined_hash(source, title, question)


def fact_rows(records: DataFrame) -> DataFrame:
    """Flat records -> fact columns: empty text to NULL, parsed date, content hash.

    The hash is the key of a fact, so no global numbering is needed.
    """
    return records.select(
        content_hash("source", "title", "question").alias("content_hash"),
        "source", topic_name(F.col("topic")).alias("topic"),
        text_or_empty("title").alias("title"), empty_to_null("question").alias("question"),
        empty_to_null("answer").alias("answer"), parse_posted("posted").alias("posted_at"),
        empty_to_null("posted").alias("posted_text"), empty_to_null("url").alias("url"))


def upsert_facts(old: DataFrame, batch: DataFrame, order: Sequence[str],
                 update: Sequence[str] = ("title",)) -> DataFrame:
    """Facts by content hash; on conflict only the ``update`` columns change."""
    once = first_rows(batch, ["content_hash"], order).select(*old.columns)
    return merge(old, once, ["content_hash"], {c: REPLACE for c in update})


def replace_links(old: DataFrame, links: DataFrame, documents: DataFrame,
                  touched: DataFrame, fact: str) -> DataFrame:
    """Fact-document links of touched facts are replaced by the distinct known ones."""
    known = (links.join(documents.select("key", "document_id"), "key")
             .select(fact, "document_id").distinct())
    return replace_children(old, known, touched, fact)


def replace_citations(old: DataFrame, citations: DataFrame, documents: DataFrame,
                      touched: DataFrame, fact: str) -> DataFrame:
    """Citations of touched facts are replaced; unknown documents stay NULL."""
    fresh = citations.join(documents.select("key", "document_id"), "key", "left").drop("key")
    return replace_children(old, fresh.select(*old.columns), touched, fact)


def load_statistics(records: DataFrame) -> DataFrame:
    """One row of totals; ``records`` has list columns ``docs`` and ``cites``."""
    return records.agg(
        F.count_distinct("source").alias("sources"),
        F.count_distinct(topic_name(F.col("topic"))).alias("topics"),
        F.count(F.lit(1)).alias("facts"),
        F.count_distinct(content_hash("source", "title", "question")).alias("hashes"),
        F.sum(F.coalesce(F.size(F.array_distinct("docs")), F.lit(0))).alias("links"),
        F.sum(F.coalesce(F.size("cites"), F.lit(0))).alias("citations"),
        F.count_if(parse_posted("posted").isNull()).alias("undated"))


def category_totals(rows: DataFrame, category: str) -> DataFrame:
    """Rows per category and, in the same pass, the grand total (NULL category)."""
    return rows.rollup(category).agg(F.count(F.lit(1)).alias("n"),
                                     F.grouping(category).cast("int").alias("is_total"))


def emptied(table: DataFrame) -> DataFrame:
    """Reset: an empty version with the same columns."""
    return table.limit(0)


# ---------------------------------------------------------------- maintenance

def doomed_facts(facts: DataFrame, *, ids: DataFrame | Sequence[int] | None = None,
                 url: str | None = None, content_hash: str | None = None,
                 title_like: str | None = None, key: str = "question_id") -> DataFrame:
    """Preview of a delete: facts by id list or table, url, hash or title pattern."""
    hit = F.lit(False)
    if url:
        hit = hit | (F.col("url") == url)
    if content_hash:
        hit = hit | (F.col("content_hash") == content_hash)
    if title_like:
        hit = hit | F.col("title").ilike(title_like)
    if isinstance(ids, DataFrame):
        marks = ids.select(F.col(key).alias("_id")).distinct().withColumn("_hit", F.lit(True))
        # The tests are made before the join, so their columns do not travel for them.
        tested = facts.withColumn("_test", F.coalesce(hit, F.lit(False)))
        rows = tested.join(marks.hint("shuffle_hash"), tested[key] == marks["_id"], "left").drop("_id")
        return rows.where(F.coalesce("_hit", F.lit(False)) | F.col("_test")).drop("_hit", "_test")
    if ids:
        hit = hit | F.col(key).isin(list(ids))
    return facts.where(F.coalesce(hit, F.lit(False)))


def delete_facts(facts: DataFrame, doomed: DataFrame, children: dict[str, DataFrame],
                 key: str = "question_id") -> dict[str, DataFrame]:
    """Facts without the doomed ones, and the child rows that still have a fact.

    The doomed keys are hashed and facts and children pass by them: narrow rows compress so
    well that a sort of one shuffle read would hold millions of them.
    """
    gone = doomed.select(key).distinct().hint("shuffle_hash")
    out = {"facts": facts.join(gone, key, "left_anti")}
    for name, child in children.items():
        out[name] = child.join(gone, key, "left_anti")
    return out


def patch_facts(facts: DataFrame, patches: DataFrame, key: str,
                fields: Sequence[str] = ("question", "answer"),
                payload: str = "raw") -> DataFrame:
    """Set fields in the columns and inside the JSON payload; other JSON keys stay.

    ``patches`` holds each key at most once.
    """
    other = patches.select(key, F.lit(True).alias("_hit"),
                           *[F.col(f).alias(f"_{f}") for f in fields])
    joined = facts.join(other, key, "left")
    kept = F.map_filter(
        F.from_json(F.coalesce(payload, F.lit("{}")), "MAP<STRING, VARIANT>"),
        lambda k, _: ~k.isin(*fields))
    added = F.map_from_arrays(
        F.array(*[F.lit(f) for f in fields]),
        F.array(*[F.col(f"_{f}").cast("variant") for f in fields]))
    hit = F.coalesce("_hit", F.lit(False))
    patched = F.to_json(F.map_concat(kept, added), {"ignoreNullFields": "false"})
    return joined.withColumns({
        **{f: F.when(hit, F.col(f"_{f}")).otherwise(F.col(f)) for f in fields},
        payload: F.when(hit, patched).otherwise(F.col(payload)),
    }).drop("_hit", *[f"_{f}" for f in fields])


def replace_payload(facts: DataFrame, patches: DataFrame, key: str,
                    fields: Sequence[str] = ("question", "answer"),
                    payload: str = "raw") -> DataFrame:
    """Whole new payload per fact; the field columns follow it."""
    joined = facts.join(patches.select(key, F.col(payload).alias("_new")), key, "left")
    hit = F.col("_new").isNotNull()
    return joined.withColumns({
        **{f: F.when(hit, F.get_json_object("_new", f"$.{f}")).otherwise(F.col(f))
           for f in fields},
        payload: F.when(hit, F.col("_new")).otherwise(F.col(payload))}).drop("_new")


def save_answers(facts: DataFrame, answers: DataFrame, key: str, now: Column) -> DataFrame:
    """Trimmed answers; blank clears the answer and its time."""
    joined = facts.join(answers.select(key, F.lit(True).alias("_hit"),
                                       F.col("ai_answer").alias("_a")), key, "left")
    text = empty_to_null(strip(F.col("_a")))
    hit = F.coalesce("_hit", F.lit(False))
    return joined.withColumns({
        "ai_answer": F.when(hit, text).otherwise(F.col("ai_answer")),
        "ai_updated": F.when(hit, F.when(text.isNotNull(), now)).otherwise(F.col("ai_updated")),
    }).drop("_hit", "_a")


# ---------------------------------------------------------------- intake

def new_rows(incoming: DataFrame, loaded: DataFrame, key: str,
             order: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not loaded yet, the first of each key."""
    fresh = incoming.join(loaded.select(key).distinct(), key, "left_anti")
    return first_rows(fresh, [key], order).select(*incoming.columns)


def read_pages(pages: DataFrame, keys: Sequence[str], page: str, fresh: str,
               patience: int) -> DataFrame:
    """Pages up to the first run of ``patience`` pages without news.

    Pages are numbered 1, 2, 3... per key.
    """
    marked = carry_last(pages, keys, [page],
                        _news=F.when(F.col(fresh) > 0, F.col(page)))
    streak = F.col(page) - F.coalesce("_news", F.lit(0))
    stops = (marked.where(streak >= patience).groupBy(*keys)
             .agg(F.min(page).alias("_stop")))
    return (marked.join(stops, list(keys), "left")
            .where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop")))
            .drop("_news", "_stop"))


def sample_rows(pool: DataFrame, exclude: DataFrame, key: str, n: int,
                seed: str = "0") -> DataFrame:
    """``n`` rows in a repeatable shuffled order, after exclusion."""
    rows = pool.join(exclude.select(key).distinct(), key, "left_anti")
    return rows.orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed))),
                        key).limit(n)


def take_missing(candidates: DataFrame, collected: DataFrame, category: str,
                 order: Sequence[str], quota: int) -> DataFrame:
    """Per category as many candidates as are still missing; quota 0 takes all."""
    if quota <= 0:
        return candidates
    have = collected.groupBy(category).agg(F.count(F.lit(1)).alias("_have"))
    ranked = row_numbers(candidates, [category], order, "_rn")
    return (ranked.join(have, category, "left")
            .where(F.col("_rn") <= F.lit(quota) - F.coalesce("_have", F.lit(0)))
            .drop("_rn", "_have"))
