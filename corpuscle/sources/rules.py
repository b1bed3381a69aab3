"""Rule tables from CSV files with a header; a repeated key counts with its largest position.

    status.csv    position,name,status,note
    cutoffs.csv   position,name,cutoff,after,before,note
    years.csv     position,name,years            (years separated by spaces)
    topics.csv    topic,priority,kind,term   (kind: keyword or document)
    sources.csv   source,code,name,site
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.operators.topics import Topic, topics_from_rules
from corpuscle.operators.validity import last_wins
from corpuscle.sources.readers import read_text_table


def read_rules(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One row per key, the one with the largest number in the column ``position``.

    The order of rows is part of the data: files may be several and are read in any order.
    """
    rows = read_text_table(spark, path).withColumn("_position", F.col("position").cast("long")).drop("position")
    return last_wins(rows, key, "_position")


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return read_rules(spark, path, "name").select("name", "status", "note")


def read_cutoffs(spark: SparkSession, path: str) -> DataFrame:
    return read_rules(spark, path, "name").select("name", "cutoff", "after", "before", "note")


def read_valid_years(spark: SparkSession, path: str) -> DataFrame:
    rows = read_rules(spark, path, "name")
    return rows.select("name", F.filter(F.split("years", " +"), lambda y: y != "").alias("years"))


def read_topics(spark: SparkSession, path: str) -> list[Topic]:
    rows = read_text_table(spark, path)
    return topics_from_rules(rows.withColumn("priority", F.col("priority").cast("int")))
