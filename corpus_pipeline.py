"""A training corpus in five stages; each takes what its predecessor kept.

Every stage gets documents and returns documents with the same columns, the last one
token ids.  Between stages the documents are Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.llm import bpe, credentials, decontaminate, language, minhash
from corpuscle.llm.queries import table, vocabulary
from corpuscle.session import cut_lineage

LEAST_SCORE = 0.5      # of the predicted language; below it a document is rejected


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts that are null, have no letter or no language that stands out."""
    model = language.train(docs, ~language.held_out(F.col("doc_id"), 3, 1))
    names = [f"c{i}" for i in range(len(docs.columns))]      # no clash with the new columns
    at = dict(zip((c.lower() for c in docs.columns), names))
    rest = tuple(n for n in names if n != at["doc_id"])
    judged = language.identify(docs.toDF(*names), model, at["doc_id"], at["text"], rest)
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)) \
        .select(*names).toDF(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id stays, once.

    Texts without a word are no copies of each other; rows with a null id are kept.
    """
    found = minhash.near_duplicates(docs)
    gone = cut_lineage(found.where(~F.col("kept")).select("doc_id").distinct())
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = cut_lineage(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count()
                        .where("count > 1").select("doc_id"))
    if again.isEmpty():
        return left
    once = left.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).union(once)


def drop_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become a mark; the number of characters follows the new text."""
    clean = credentials.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                            .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)) \
        .select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number, their hash and that of the decoded text."""
    coded = bpe.encode(docs, vocabulary())
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", drop_test_passages),
    ("secrets", redact_secrets),
    ("tokens", tokenize),
]

ORACLE_SQL = None      # sketches, tiles, models and tokens are not SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
