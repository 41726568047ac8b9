"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 200_000  # rows of an input that a task works on at most

# SQL settings the operators rely on or profit from; all can change at runtime.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Written facts are narrow and exploded into many elements: small splits bound a task.
    "spark.sql.files.maxPartitionBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a folder of its own; on a
    cluster that would be lost with its machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clamor-"))
    return spark.sparkContext.getCheckpointDir()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared one."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once, so that several readers do not
    repeat the work before them and a lost executor does not either."""
    spark = df.sparkSession
    path = work_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for costly row work, in tasks of a bounded number of rows.

    A file has as many splits as its size tells, but rows come by row groups, so some
    splits may be empty and others hold very many rows.  Inputs whose splits are enough
    and hold few rows each are left alone.  Only row counts are read for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    counted = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    size = counted.agg(F.sum("n").alias("rows"), F.max("n").alias("largest")).first()
    rows, largest = size["rows"] or 0, size["largest"] or 0
    even = largest <= ROWS_PER_TASK and largest * cores <= 2 * rows
    if even and df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(max(cores, -(-rows // ROWS_PER_TASK)), key)
