"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clamor.session import materialise, work_folder

__all__ = ["fresh", "materialise", "prepared", "remove", "table", "text_or_empty", "work_folder"]


# Rows of a record batch to and from Python.  Texts are long: Spark's default of 10,000
# would hold tens of megabytes of them in each task, several times over.
BATCH_ROWS = "512"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with record batches that suit long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened by underscores until no column of df clashes.

    Spark compares names without case, and so does this.
    """
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
