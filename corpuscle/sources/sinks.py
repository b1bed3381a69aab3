"""Exports and versioned tables.

Spark's commit protocol makes a write all-or-nothing; a table is never
overwritten while it is read, a new version folder is written instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_json_values(df: DataFrame) -> DataFrame:
    """Types JSON does not know (times, dates, decimals, binary) become text."""
    odd = (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType, T.BinaryType)
    return df.select(*[
        F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, odd)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def export_rows(spark: SparkSession, what: str, path: str) -> None:
    """A table name or a SELECT -> JSON rows."""
    text = what.strip()
    is_query = text.lower().startswith(("select", "with"))
    df = spark.sql(text) if is_query else spark.table(text)
    as_json_values(df).write.mode("errorifexists").json(path)


def write_buckets(df: DataFrame, bucket: str, path: str) -> None:
    """One folder per status bucket."""
    df.write.mode("errorifexists").partitionBy(bucket).json(path)


def csv_frame(df: DataFrame) -> DataFrame:
    """Cells ready for CSV: lists joined with '/', line breaks turned into spaces."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), "/")
        columns.append(F.coalesce(F.regexp_replace(column.cast("string"), r"\r?\n", " "),
                                  F.lit("")).alias(f.name))
    return df.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    csv_frame(df).write.mode("errorifexists").csv(path, header=True, quoteAll=True, escape='"')


def write_frames(frames: dict[str, DataFrame], path: str) -> None:
    """Several named results, one folder each."""
    for name, df in frames.items():
        write_csv(df, f"{path}/{name}")


def deliverable(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The listed keys in order; a missing or NULL text becomes ''."""
    def pick(key: str):
        if key not in df.columns:
            return F.lit("").alias(key)
        if isinstance(df.schema[key].dataType, T.StringType):
            return F.coalesce(F.col(key), F.lit("")).alias(key)
        return F.col(key)

    return df.select(*[pick(k) for k in keys])


def map_rows(config: DataFrame, key: str) -> DataFrame:
    """Configuration as one JSON object per key, ready for ``write.text``."""
    rest = [c for c in config.columns if c != key]
    return config.select(F.col(key), F.to_json(F.struct(*rest)).alias("value"))


# ---------------------------------------------------------------- versioned tables

def _versions(spark: SparkSession, root: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(done):
            found.append(int(name[1:]))
    return sorted(found)


def write_version(df: DataFrame, root: str) -> int:
    """Write the next version; readers see it once it is committed.

    Of two writers that take the same number, the later one fails.
    """
    versions = _versions(df.sparkSession, root)
    number = (versions[-1] if versions else 0) + 1
    df.write.mode("errorifexists").parquet(f"{root}/v{number:06d}")
    return number


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """The latest committed version (or the given one), None when there is none."""
    versions = _versions(spark, root)
    if number is None and not versions:
        return None
    return spark.read.parquet(f"{root}/v{(number or versions[-1]):06d}")
