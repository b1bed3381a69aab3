"""Session helpers shared by the tests, the benchmark and the jobs."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corpuscle", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    ANSI mode stays on (the operators use ``try_*`` where bad input is legal),
    AQE picks join strategies, coalesces partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, for checkpoints and staged tables.

    It is the cluster's ``spark.checkpoint.dir``.  A local session without that
    setting uses a folder of its own below the warehouse, removed when the driver
    ends; a cluster without it is an error, since nothing else is known to be shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        folder = f"{warehouse}/staged-{spark.sparkContext.applicationId}"
        atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder.

    Iterative jobs call this each round: the plan starts again from files that
    outlive executors, and the rows are computed once.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
