"""Streaming star-schema load: the batch load of ``operators.star`` per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.functions.text import empty_to_null
from corpuscle.operators.names import document_key, document_type
from corpuscle.operators.star import content_hash, document_dimension, topic_name
from corpuscle.streaming.tables import BUCKETS, drop_batch, read_batches, stored_keys, write_batch, written_once

FACTS = ("content_hash STRING, source STRING, topic STRING, title STRING, question STRING, "
         "answer STRING, new BOOLEAN")
DOCUMENTS = "key STRING, name STRING, number STRING, link STRING, type STRING"
LINKS = "content_hash STRING, key STRING"
CITATIONS = ("content_hash STRING, key STRING, article STRING, clause STRING, point STRING, "
             "quoted STRING")


def load_batch(batch: DataFrame, root: str, batch_id: int, order: Sequence[str],
               buckets: int = BUCKETS, hold: bool = True) -> None:
    """One micro-batch of flat records (``docs`` and ``cites`` arrays) into four tables.

    A fact keeps the first record of its hash but the title of the last one;
    links and citations are those of the last record.

    The facts and the documents each read the batch once.  ``hold`` keeps it between the two, so that
    a batch with state, or one that is dear to compute, is computed once; without ``hold`` rows that a stream
    merely reads from files are read again, and nothing of the size of the batch is held.
    """
    place = F.struct(*order)
    rows = batch.withColumn("content_hash", content_hash("source", "title", "question"))
    if hold:
        rows = rows.persist()
    facts = rows.groupBy("content_hash").agg(
        F.min_by(F.struct(
            "source", topic_name(F.col("topic")).alias("topic"),
            empty_to_null("question").alias("question"),
            empty_to_null("answer").alias("answer")), place).alias("f"),
        F.max_by("title", place).alias("title"),
        F.max_by(F.struct("docs", "cites"), place).alias("l"))
    facts = facts.select("content_hash", "f.*", "title", "l.docs", "l.cites")
    try:
        # Three tables come from the facts, which are computed once per batch.
        _write_tables(rows, written_once(facts, f"{root}/held", batch_id), root, batch_id, order, buckets)
    finally:
        drop_batch(batch.sparkSession, f"{root}/held", batch_id)
        if hold:
            rows.unpersist()


def _write_tables(rows: DataFrame, facts: DataFrame, root: str, batch_id: int, order: Sequence[str],
                  buckets: int) -> None:
    # Only the buckets of this batch's hashes are looked into.
    stored = stored_keys(facts, f"{root}/facts", FACTS, "content_hash", batch_id, buckets).where("new").select(
        "content_hash", F.lit(False).alias("_new"))
    marked = facts.join(stored.distinct(), "content_hash", "left").withColumn(
        "new", F.coalesce("_new", F.lit(True)))
    write_batch(marked.select("content_hash", "source", "topic", "title", "question", "answer",
                              "new"), f"{root}/facts", batch_id, "content_hash", buckets)

    docs = facts.select("content_hash", F.explode("docs").alias("d")).select("content_hash", "d.*")
    links = docs.where(F.coalesce("name", F.lit("")) != "").select(
        "content_hash", document_key(F.col("name"), F.col("number")).alias("key")).distinct()
    write_batch(links, f"{root}/links", batch_id)

    cites = facts.select("content_hash", F.explode("cites").alias("c")).select("content_hash", "c.*")
    write_batch(cites.select(
        "content_hash", F.when(F.coalesce("document", F.lit("")) != "", document_key(
            F.col("document"), F.col("number"))).alias("key"),
        *[empty_to_null(c).alias(c) for c in ("article", "clause", "point", "quoted")]),
        f"{root}/citations", batch_id)

    mentions = rows.select(*order, F.posexplode("docs").alias("pos", "d")).select(
        *order, "pos", "d.*")
    write_batch(document_dimension(mentions, (*order, "pos")).select(
        "key", "name", "number", "link", "type"), f"{root}/documents", batch_id)


def start_load(stream: DataFrame, root: str, checkpoint: str, order: Sequence[str], buckets: int = BUCKETS,
               hold: bool = True):
    """Load everything that is there, batch by batch, then stop; ``hold`` as in ``load_batch``."""
    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, root, batch_id, order, buckets, hold)

    return (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def facts_table(spark: SparkSession, root: str) -> DataFrame:
    """First version of each fact, with the last title."""
    rows = read_batches(spark, f"{root}/facts", FACTS)
    return rows.groupBy("content_hash").agg(
        F.min_by(F.struct("source", "topic", "question", "answer"), "batch").alias("f"),
        F.max_by("title", "batch").alias("title")).select(
        "content_hash", "f.source", "f.topic", "title", "f.question", "f.answer")


def documents_table(spark: SparkSession, root: str) -> DataFrame:
    """First name, first filled number and link of each document."""
    rows = read_batches(spark, f"{root}/documents", DOCUMENTS)
    out = rows.groupBy("key").agg(
        F.min_by("name", "batch").alias("name"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("batch"))).alias(c)
          for c in ("number", "link")])
    return out.withColumn("type", document_type(F.col("name")))


def _latest(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """Children of the last batch that touched their fact."""
    touched = read_batches(spark, f"{root}/facts", FACTS).groupBy("content_hash").agg(
        F.max("batch").alias("batch"))
    return read_batches(spark, f"{root}/{table}", schema).join(
        touched, ["content_hash", "batch"], "left_semi").drop("batch")


def links_table(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, root, "links", LINKS)


def citations_table(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, root, "citations", CITATIONS)
