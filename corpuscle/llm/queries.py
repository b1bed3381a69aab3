"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, credentials, decontaminate, html_template, jacobi_davidson, language, lattice, minhash,
               ns_bounds, quality, toxicity, urls, va_file)

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """Where the installed tokenizer package keeps the vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = language.held_out(F.col("doc_id"), 5, 0)
    chain = toxicity.train(docs, labels, ~held)
    docs = docs.select("doc_id", "text", held.alias("held_out"))
    return toxicity.score(docs, chain, keep=("held_out",))


def op2_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(table(spark, folder, "embeddings"))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = language.held_out(F.col("doc_id"), 3, 1)
    model = language.train(docs, ~held)
    docs = docs.select("doc_id", "text", held.alias("held_out"))
    return language.identify(docs, model, keep=("held_out",))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.digest(credentials.scan(table(spark, folder, "documents")))


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"))


def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_template.extract(table(spark, folder, "pages"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")) \
        .drop("spans")


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), vocabulary(), digest=True)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = language.held_out(F.col("doc_id"), 5, 0)
    model = quality.train(docs, labels, ~held)
    docs = docs.select("doc_id", "text", held.alias("held_out"))
    return quality.score(docs, model, keep=("held_out",)) \
        .withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return jacobi_davidson.whiten(table(spark, folder, "embeddings"))


def op12_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return va_file.top_k(table(spark, folder, "embeddings"))


def op13_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return ns_bounds.cluster(table(spark, folder, "embeddings"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


def oracle_sql() -> dict[str, str]:
    return {"op2_lattice": lattice.SQL, "op4_secrets": credentials.oracle(), "op8_minhash": minhash.SQL,
            "op12_top_k": va_file.SQL, "op13_clusters": ns_bounds.oracle()}
