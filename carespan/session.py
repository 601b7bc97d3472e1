"""Session settings the plans count on, and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so they can be applied to a session that is already running. Hot keys are
# split at run time by the skew-join rule, also where the split costs one more shuffle.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Batches to Python workers are bounded by bytes, as rows may hold very long texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the one the cluster names in spark.checkpoint.dir.

    In local mode the warehouse folder takes its place where the setting is missing. On a cluster it must
    be set: a folder beside the driver is not one that executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/carespan-{uuid.uuid4().hex}"


def files_of(spark: SparkSession, path: str):
    """The path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_at_end(spark: SparkSession, path: str) -> str:
    """Have a written folder deleted when the session's file system is closed."""
    where, files = files_of(spark, path)
    files.deleteOnExit(where)
    return path


def written(rows: DataFrame) -> DataFrame:
    """The rows, written to a shared folder once and read back; the files go when the session ends.

    For rows that are read more than once and must be the same each time. No executor holds them, so a
    lost one costs its running tasks only.
    """
    spark = rows.sparkSession
    path = shared_folder(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(drop_at_end(spark, path))
