"""Reading nested and flat JSON, tables of text, OCR caches and annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.sources.json_arrays import read_json_arrays

__all__ = ["read_annotations", "read_json_arrays", "read_nested", "read_ocr", "read_text_table"]

DOCUMENT_ELEMENT = "name STRING, number STRING, link STRING"
CITATION_ELEMENT = ("document STRING, number STRING, article STRING, clause STRING, "
                    "point STRING, quoted STRING, link STRING")
QUESTION_ELEMENT = ("title STRING, question STRING, answer STRING, author STRING, date STRING, "
                    "url STRING, reference STRING")
NESTED_SCHEMA = (
    "source STRING, total_questions INT, categories ARRAY<STRUCT<slug: STRING, name: STRING, "
    f"count: INT, done: BOOLEAN, questions: ARRAY<STRUCT<{QUESTION_ELEMENT.replace(' STRING', ': STRING')}>>>>")
OCR_SCHEMA = (
    "file STRING, lang STRING, engine STRING, pages ARRAY<STRUCT<page: INT, text: STRING, "
    "text_raw: STRING, text_vietocr: STRING, text_gemini: STRING, gemini_model: STRING, "
    "gemini_loi: STRING>>")


def explode_nested(datasets: DataFrame) -> DataFrame:
    """dataset -> category -> question, carrying source and category name."""
    categories = datasets.select("source", F.explode("categories").alias("c"))
    return categories.select("source", F.col("c.slug").alias("slug"),
                             F.col("c.name").alias("category"),
                             F.explode("c.questions").alias("q")).select(
        "source", "slug", "category", "q.*")


def read_nested(spark: SparkSession, paths: str | Sequence[str],
                schema: str | T.StructType = NESTED_SCHEMA, lines: bool = False) -> DataFrame:
    """Nested crawl datasets as flat question rows: one object per file, or one per line
    (``lines``), which large files need to be read in parallel."""
    return explode_nested(spark.read.schema(schema).json(paths, multiLine=not lines))


def read_text_table(spark: SparkSession, path: str, line_breaks: bool = False, **options) -> DataFrame:
    """CSV with a header; every column is text and missing cells are ''.

    Files are split between tasks.  With ``line_breaks`` inside quoted cells a file
    cannot be split and is one task.
    """
    rows = spark.read.options(header=True, inferSchema=False, multiLine=line_breaks, escape='"',
                              **options).csv(path)
    return rows.na.fill("")


def read_annotations(spark: SparkSession, folder: str, schema: str,
                     list_fields: Sequence[str] = (), merged: str = "_all.json",
                     pattern: str = "*.json") -> DataFrame:
    """All annotation files of a folder but the merged one; unreadable files are skipped.

    A ``list_fields`` value written as one object counts as a list of one.
    """
    files = (spark.read.option("pathGlobFilter", pattern).option("wholetext", True).text(folder)
             .select("value", F.col("_metadata.file_name").alias("file_name"))
             .where(F.col("file_name") != merged))
    good = files.where(F.try_parse_json("value").isNotNull())
    row_type = T._parse_datatype_string(schema)
    for name in list_fields:
        pass_through = F.get_json_object("value", f"$.{name}")
        good = good.withColumn(f"_l_{name}", F.when(
            F.startswith(pass_through, F.lit("{")),
            F.concat(F.lit("["), pass_through, F.lit("]"))).otherwise(pass_through))
    out = good.withColumn("r", F.from_json("value", row_type))
    columns = []
    for field in row_type.fields:
        if field.name in list_fields:
            columns.append(F.from_json(f"_l_{field.name}", field.dataType).alias(field.name))
        else:
            columns.append(F.col(f"r.{field.name}").alias(field.name))
    return out.select("file_name", *columns)


def ocr_pages(files: DataFrame) -> DataFrame:
    """One row per page of the OCR caches."""
    return files.select("file", "lang", "engine", F.posexplode("pages").alias("pos", "p")).select(
        "file", "lang", "engine", "pos", "p.*")


def read_ocr(spark: SparkSession, paths: str | Sequence[str],
             schema: str | T.StructType = OCR_SCHEMA, lines: bool = False) -> DataFrame:
    """Pages of recognition caches: one object per file, or one per line (``lines``)."""
    return ocr_pages(spark.read.schema(schema).json(paths, multiLine=not lines))
