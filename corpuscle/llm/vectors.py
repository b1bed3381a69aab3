"""Shared by the vector operators: rows of numbers, staged tables, sums over all rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def finite(vector: Column) -> Column:
    """The vector is there and holds neither nulls nor NaN nor infinities (never null itself)."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def scaled(vector: Column, factor: int, limit: int) -> Column:
    """floor(factor * c) of every component as long, held between -limit and limit."""
    return F.transform(vector, lambda c: F.floor(
        F.greatest(F.least(c.cast("double") * factor, F.lit(float(limit))), F.lit(float(-limit)))).cast("long"))


class Stage:
    """Tables in the shared folder that one job writes and may drop again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        self.written: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.written)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.written.append((out, path))
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove a table that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(next(p for t, p in self.written if t is df))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists are equally long, as rows; it has no nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def total(rows: DataFrame, column: str, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``work(rows of a slice)``, a flat array of fixed length, over all rows.

    Every task adds its slices up and hands one array on; the arrays of the tasks are
    summed by position on the executors, so the driver gets one number per position.
    """
    sql_type, arrow = ("ARRAY<DOUBLE>", pa.list_(pa.float64())) if kind == "double" else \
        ("ARRAY<BIGINT>", pa.list_(pa.int64()))
    schema = pa.schema([("part", arrow)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = work(matrix(batch.slice(start, 4096).column(0)))
                held = part if held is None else held + part
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tolist()], arrow)], schema=schema)

    value = F.col("value") if kind == "double" else F.col("value").cast("decimal(38,0)")
    found = rows.select(column).mapInArrow(run, f"part {sql_type}") \
        .select(F.posexplode("part").alias("at", "value")) \
        .groupBy("at").agg(F.sum(value).alias("value")).collect()
    out = np.zeros(len(found), dtype=np.float64 if kind == "double" else object)
    for at, value in found:
        out[at] = value if kind == "double" else int(value)
    return out
