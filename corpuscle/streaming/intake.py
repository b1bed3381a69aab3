"""Streaming intake: rows by url or content hash, the first arrival wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscle.operators.ordered import first_rows
from corpuscle.streaming.tables import BUCKETS, read_batches, stored_keys, write_batch


def watermark_dedupe(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within the watermark; state is kept for that span only."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def start_intake(stream: DataFrame, root: str, checkpoint: str, key: str,
                 order: Sequence[str], buckets: int = BUCKETS):
    """Append the rows whose key no earlier batch holds; stops when the input is used up.

    A batch is computed once.  Of the earlier batches only the key column in the buckets
    that the batch's keys fall into is read, and anti-joined on the key; a batch of few
    keys costs the same however many are stored elsewhere.  Null keys are one key.
    """
    schema = T.StructType([f for f in stream.schema.fields])

    def load(batch: DataFrame, batch_id: int) -> None:
        fresh = first_rows(batch, [key], order).select(*batch.columns).persist()
        try:
            stored = stored_keys(fresh, root, schema, key, batch_id, buckets).select(F.col(key).alias("_stored"))
            new = fresh.join(stored, F.col(key).eqNullSafe(F.col("_stored")), "left_anti")
            write_batch(new.select(*batch.columns), root, batch_id, key, buckets)
        finally:
            fresh.unpersist()

    return (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def intake_table(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    return read_batches(spark, root, schema).drop("batch")
