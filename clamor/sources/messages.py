"""Messages in and out: topic or JSON-lines files, decode, encode, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clamor.schema import MESSAGE

RECORDS_PER_TRIGGER = 5000

# Times on the wire keep their microseconds.
WIRE_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def topic_stream(
    spark: SparkSession, servers: str, topic: str, records_per_trigger: int = RECORDS_PER_TRIGGER
) -> DataFrame:
    """Rows (key, value) of a topic from now on; needs Spark's Kafka package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", records_per_trigger)
        .load()
    )


def file_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Rows (value) of JSON-lines files as they arrive in a folder."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
    )


def decode(rows: DataFrame, value: str = "value") -> DataFrame:
    """Message columns of a JSON value.

    The schema is fixed.  A malformed value gives nulls in every column, a
    field of the wrong type a null in that column.

    The generator keeps Spark from moving later filters below the columns, where each
    condition would parse the value once more.
    """
    parsed = F.from_json(F.col(value).cast("string"), MESSAGE)
    return rows.select(F.inline_outer(F.array(parsed)))


def encode(messages: DataFrame) -> DataFrame:
    """(key, value) of each message: its id, and its columns as JSON."""
    columns = [F.col(f.name) for f in MESSAGE]
    return messages.select(
        F.col("mention_id").alias("key"), F.to_json(F.struct(*columns), WIRE_TIME).alias("value")
    )


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Messages of several publishers, each tagged with its origin."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, tagged)


def write_files(messages: DataFrame, folder: str, rows_per_file: int) -> None:
    """Messages as JSON-lines files of a bounded size."""
    encode(messages).select("value").write.mode("append").option(
        "maxRecordsPerFile", rows_per_file
    ).text(folder)


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Messages to a topic, keyed by id; needs Spark's Kafka package."""
    encode(messages).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
