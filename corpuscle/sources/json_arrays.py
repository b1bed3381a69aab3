"""JSON arrays of objects, read in byte ranges.

A file is cut at every closing brace, which Spark's text source does in splits of any
size.  Whether a brace ends a record depends on all that stands before it, but only
through two numbers: the parity of the quotes (inside a string or not) and the depth of
brackets.  So every split is summed up for both parities, the few sums of a file are
run through in order, and with the state at its start each split finds the ends of
its records by itself.  Only pieces of records cross the border of a split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT = ["file", "split"]


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Text up to each closing brace with its place, its quotes, and its change of depth.

    ``even`` is the change when the piece begins outside a string, ``odd`` inside one;
    the brace at its end is counted by what the piece ends in.
    """
    raw = spark.read.option("lineSep", "}").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"))
    plain = raw.withColumn("parts", F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1))
    quotes = F.size("parts") - 1

    def change(inside: int) -> Column:
        outside = F.array_join(F.filter("parts", lambda p, i: i % 2 == inside), "")
        return _count(outside, "{[") - _count(outside, "}]") - F.when((quotes + inside) % 2 == 0, 1).otherwise(0)

    return plain.select("value", *SPLIT, "at", (quotes % 2).alias("quotes"), change(0).alias("even"),
                        change(1).alias("odd"), F.ltrim(F.substring("value", 1, 64)).alias("head"))


def _running(pieces: DataFrame, start: Column) -> DataFrame:
    """Depth behind every piece, relative to the split's start, which lies inside a string if ``start`` is 1."""
    order = Window.partitionBy(*SPLIT).orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) + start) % 2
    rows = pieces.withColumn("change", F.when(inside == 0, F.col("even")).otherwise(F.col("odd"))) \
        .withColumn("ends_outside", (inside + F.col("quotes")) % 2 == 0)
    return rows.withColumn("depth", F.sum("change").over(order))


def _summary(pieces: DataFrame) -> DataFrame:
    """Per split: parity of quotes, and for both states at its start the change of depth and how
    often a brace leaves each depth."""
    out = None
    for start in (0, 1):
        rows = _running(pieces.drop("value"), F.lit(start))
        seen = rows.groupBy(*SPLIT, "depth").agg(
            F.count_if("ends_outside").alias("n"), F.sum("change").alias("change"), F.sum("quotes").alias("quotes"),
            F.min_by("head", "at").alias("head"), F.min("at").alias("at"), F.max("at").alias("last"))
        part = seen.groupBy(*SPLIT).agg(
            F.sum("change").alias(f"change{start}"), (F.sum("quotes") % 2).alias("quotes"),
            F.map_from_entries(F.collect_list(F.struct("depth", "n"))).alias(f"ends{start}"),
            F.min_by("head", "at").alias("head"), F.max("last").alias("last"))
        out = part if out is None else out.join(part.drop("quotes", "head", "last"), SPLIT)
    return out


def _starts(summary: DataFrame) -> DataFrame:
    """State at the start of every split: inside a string, depth, records ended before.

    A file has one row per split here, which are run through in order.
    """
    order = Window.partitionBy("file").orderBy("split")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    rows = summary.withColumn("inside", inside)
    pick = lambda name: F.when(F.col("inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))     # noqa: E731
    rows = rows.withColumns({"change": pick("change"), "ends": pick("ends")})
    rows = rows.withColumn("depth0", F.coalesce(F.sum("change").over(before), F.lit(0)))
    ended = F.coalesce(F.try_element_at("ends", 1 - F.col("depth0")), F.lit(0))
    rows = rows.withColumn("records0", F.coalesce(F.sum(ended).over(before), F.lit(0)))
    first = F.first("head").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The last piece of a file ends with the file, not with a brace.
    tail = F.when(F.lead("split").over(order).isNull(), F.col("last"))
    return rows.select(*SPLIT, "inside", "depth0", "records0", F.startswith(first, F.lit("[")).alias("array"),
                       tail.alias("tail"))


def read_json_arrays(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """Records of files that each hold one JSON array of objects; other files are skipped.

    ``schema`` is the DDL of one record.  Files of any size are read in splits of
    ``spark.sql.files.maxPartitionBytes``; a task holds one split, and a record is put
    together from its pieces.  White space of up to 64 characters may stand before the
    array.  Records that cannot be parsed have only nulls; of an array that breaks off, the
    records before the break are read.
    """
    pieces = _pieces(spark, paths)
    starts = _starts(_summary(pieces))
    rows = pieces.drop("head").join(starts.where("array").drop("array"), SPLIT)
    rows = _running(rows, F.col("inside")).withColumn("depth", F.col("depth") + F.col("depth0"))
    # A record ends with a brace outside strings that leaves only the array open.
    end = ((F.col("depth") == 1) & F.col("ends_outside") & ~F.col("at").eqNullSafe(F.col("tail"))).cast("int")
    before = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"end": end, "record": F.coalesce(F.sum(end).over(before), F.lit(0)) + F.col("records0")})
    texts = rows.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("parts"), F.max("end").alias("whole"))
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    record = F.from_json(F.regexp_replace(text, r"^[\s,\[]*", ""), T._parse_datatype_string(schema))
    return texts.where("whole = 1").select(record.alias("r")).select("r.*")
