"""The streaming job: messages to facts, buckets, graph and batch records."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clamor.functions.scoring import with_scores
from clamor.operators.graph import graph_elements
from clamor.operators.mentions import mention_facts, new_mentions, split_rejects, valid_rows
from clamor.operators.reports import batch_record, buckets, with_batch_accuracy
from clamor.session import configure
from clamor.sources.messages import WIRE_TIME, decode
from clamor.sources.store import MentionStore

LOG = logging.getLogger(__name__)

DELAY = "1 day"  # how late a message may be
FOLD_EVERY = 50  # batches after which the graph ledgers are folded into a new base

# Counters of the log line of a batch, beside the graph sizes.
SUMMARY = [
    "messages", "accuracy", "decisions", "bound", "opinions", "max_tokens", "positive", "neutral",
    "negative",
]

# Keeps large streaming state on local disk of the executors, backed by the
# checkpoint, instead of on their heap.  What its tables hold in memory is bounded for
# each executor, not for each of them, and a batch adds only what it changed to the
# checkpoint.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def process_batch(
    store: MentionStore,
    run_id: str,
    brand: str,
    messages: DataFrame,
    batch_id: int,
    ledgers_whole: bool = False,
) -> dict | None:
    """Store one batch and return its counters; None if there was nothing to do.

    An empty batch is skipped, and so is one that is already complete.

    Facts are written first, and everything else is computed from the written
    partition: texts are scored once, and a lost executor costs no rescoring.  Facts and
    record carry the one time of the batch, also where no row is new.
    """
    if store.is_complete(run_id, batch_id):
        return None
    now = F.lit(messages.sparkSession.sql("SELECT current_timestamp()").first()[0])
    messages = messages.persist()  # decoded once for all that follows
    try:
        # Once it is held, Spark knows its size, and sends its ids to the history scan if
        # they are small enough to be broadcast.
        if messages.count() == 0:
            return None
        accepted, rejected = split_rejects(messages)
        new = new_mentions(accepted, store.known_ids(run_id, batch_id, ledgers_whole))
        facts = mention_facts(new.withColumn("processed_at", now), ("processed_at",))
        store.write_batch("mentions", facts, run_id, batch_id)
        message = F.to_json(F.struct(*messages.columns), WIRE_TIME).alias("message")
        store.write_batch(
            "rejects", rejected.select("mention_id", "ts", "reason", message), run_id, batch_id
        )
    finally:
        messages.unpersist()
    stored = store.read_batch("mentions", run_id, batch_id)
    store.write_batch("ids", stored, run_id, batch_id)
    store.write_batch("buckets", buckets(stored), run_id, batch_id)
    sizes, counters = Observation(), Observation()
    elements = graph_elements(stored).observe(
        sizes,
        F.count_if(F.col("dst").isNull()).alias("nodes"),
        F.count_if(F.col("dst").isNotNull()).alias("edges"),
    )
    store.write_batch("graph", elements, run_id, batch_id)
    stats = with_batch_accuracy(batch_record(stored, ())).na.fill(0)
    # One row; its values are observed as it is written.
    stats = stats.withColumns({"brand": F.lit(brand), "processed_at": now}).observe(
        counters, *[F.max(c).alias(c) for c in SUMMARY]
    )
    store.write_batch("batch_stats", stats, run_id, batch_id)
    return {**counters.get, **sizes.get}


def start(
    values: DataFrame,
    root: str,
    checkpoint: str,
    brand: str,
    trigger_seconds: int | None = 10,
    delay: str = DELAY,
) -> StreamingQuery:
    """Start the job on a stream of JSON values.

    Without ``trigger_seconds`` the query works off what is there and ends.  Copies that
    come within ``delay`` of each other are dropped by the state of the stream, and so are
    messages later than that (``late_rows`` counts them); ids that are stored already are
    left out exactly, behind it.  The session of ``values`` gets the settings of that state.
    """
    spark = values.sparkSession
    use_state_settings(spark)
    store = MentionStore(spark, root)
    ledgers_whole = True
    try:
        store.rebuild_ledgers(brand, run_of(spark, checkpoint))
    except Exception as error:  # the stream has to start in any case
        ledgers_whole = False
        LOG.warning("ledgers not rebuilt: %s", error)

    def on_batch(messages: DataFrame, batch_id: int) -> None:
        # Streaming switches adaptive execution off in the session of its
        # batches; these are ordinary queries and profit from it.
        session = configure(messages.sparkSession)
        run_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        here = MentionStore(session, root)
        summary = process_batch(here, run_id, brand, messages, batch_id, ledgers_whole)
        LOG.info("batch %s of run %s: %s", batch_id, run_id, summary or "nothing to do")
        if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
            here.fold_graph()

    writer = (
        first_copies(valid_rows(decode(values)), delay)
        .writeStream.foreachBatch(on_batch)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def run_of(spark: SparkSession, checkpoint: str) -> str | None:
    """Id of the query that a checkpoint belongs to; None for a new one."""
    if not MentionStore(spark, checkpoint).exists(f"{checkpoint}/metadata"):
        return None
    found = F.get_json_object("value", "$.id").alias("id")
    return spark.read.text(f"{checkpoint}/metadata").select(found).first()["id"]


def use_state_settings(spark: SparkSession) -> None:
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)


def unique_stream(messages: DataFrame, delay: str = "1 hour", *apart: str) -> DataFrame:
    """First copy of each mention as long as copies lie within ``delay``.

    An id is one entry of state and each message is shuffled once; a first pass per input
    partition would keep every id twice.  Columns named in ``apart`` are part of the key.
    """
    return messages.withWatermark("ts", delay).dropDuplicatesWithinWatermark(
        ["mention_id", *apart]
    )


def first_copies(messages: DataFrame, delay: str) -> DataFrame:
    """``unique_stream`` of the messages with a time; those without one, which will be
    rejected, all pass, as each has a key of its own.

    A union of the two would read and parse every message once more.
    """
    own = F.when(F.col("ts").isNull(), F.expr("uuid()"))
    return unique_stream(messages.withColumn("_own", own), delay, "_own").drop("_own")


def late_rows(query: StreamingQuery) -> int:
    """Messages that came too late in the batches whose progress is still known."""
    return sum(
        int(state.numRowsDroppedByWatermark)
        for progress in query.recentProgress
        for state in progress.stateOperators
    )


def live_buckets(messages: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Running mentions per minute and class of accepted, unique messages; copies and
    rows later than ``delay`` are left out, which bounds the state."""
    accepted, _ = split_rejects(messages)
    return (
        with_scores(unique_stream(accepted, delay))
        .groupBy(F.window("ts", "1 minute"), "sentiment")
        .agg(F.count("*").alias("mentions"))
        .select(F.col("window.start").alias("bucket"), "sentiment", "mentions")
    )


def live_mentions(messages: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Id, minute and class of accepted, unique messages as they come.

    Its only state are the ids of the last ``delay``; what is counted is kept by id in the
    written rows, so a lost checkpoint counts nothing twice.
    """
    accepted, _ = split_rejects(messages)
    return with_scores(unique_stream(accepted, delay)).select(
        "mention_id", F.date_trunc("minute", "ts").alias("bucket"), "sentiment"
    )


def write_live_buckets(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    trigger_seconds: int | None = None,
    mode: str = "update",
) -> StreamingQuery:
    """Keep the rows of ``live_mentions`` (mode append) or the updates of ``live_buckets``,
    one folder per run and batch."""

    def on_batch(updates: DataFrame, batch_id: int) -> None:
        run_id = updates.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        updates.write.mode("overwrite").parquet(f"{folder}/run_id={run_id}/batch_id={batch_id}")

    writer = (
        rows.writeStream.foreachBatch(on_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def read_live_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Count of each bucket from the updates of ``live_buckets``: the latest of each run,
    as counts of a run only grow, added up over runs that read different messages."""
    latest = (
        spark.read.parquet(folder)
        .groupBy("run_id", "bucket", "sentiment")
        .agg(F.max("mentions").alias("mentions"))
    )
    return latest.groupBy("bucket", "sentiment").agg(F.sum("mentions").alias("mentions"))


def read_live_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Count of each bucket from the rows of ``live_mentions``.

    Ids are unique within a run.  Where there are several runs, a mention that more than
    one of them has read counts once.
    """
    rows = spark.read.parquet(folder)
    if rows.select("run_id").distinct().limit(2).count() > 1:
        first = F.min(F.struct("run_id", "bucket", "sentiment")).alias("m")
        rows = rows.groupBy("mention_id").agg(first).select("m.bucket", "m.sentiment")
    return rows.groupBy("bucket", "sentiment").agg(F.count("*").alias("mentions"))
