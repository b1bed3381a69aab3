"""Tables that grow by micro-batches.

Every micro-batch writes its own folder, named by the batch id and replaced as
a whole when the batch is replayed.  A batch only reads what earlier batches
wrote, so running it again gives the same folder; nothing that is already
written is rewritten, and readers merge on read.

Tables that a batch looks its keys up in are dealt into buckets by the key's hash, as
folders below the batch.  A lookup names the buckets of its keys, so it reads those
and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


BUCKETS = 64
BUCKET = "bucket"


def bucket_of(key: Column | str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_batch(df: DataFrame, root: str, batch_id: int, key: str | None = None, buckets: int = BUCKETS) -> None:
    """Write one batch; with ``key`` into the buckets of that column, a file each."""
    path = f"{root}/batch={batch_id}"
    if key is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET).write.partitionBy(BUCKET) \
            .mode("overwrite").parquet(path)


def written_once(df: DataFrame, root: str, batch_id: int) -> DataFrame:
    """The rows from the folder they are written to for the time of the batch; ``drop_batch`` removes it."""
    write_batch(df, root, batch_id)
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/batch={batch_id}")


def drop_batch(spark: SparkSession, root: str, batch_id: int) -> None:
    path, system = _hadoop(spark, f"{root}/batch={batch_id}")
    system.delete(path, True)


def stored_keys(keys: DataFrame, root: str, schema: T.StructType | str, key: str, before: int,
                buckets: int = BUCKETS) -> DataFrame:
    """What earlier batches wrote into the buckets of ``keys``, of which there are ``buckets`` at most."""
    touched = [r[0] for r in keys.select(bucket_of(key, buckets)).distinct().collect()]
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return read_batches(keys.sparkSession, root, full, before).where(F.col(BUCKET).isin(touched))


def read_batches(spark: SparkSession, root: str, schema: T.StructType | str,
                 before: int | None = None) -> DataFrame:
    """All rows with their ``batch``; ``before`` prunes to the earlier batch folders."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    path, system = _hadoop(spark, root)
    if not system.exists(path):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).parquet(root)
    return rows.where(F.col("batch") < before) if before is not None else rows


def _hadoop(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
