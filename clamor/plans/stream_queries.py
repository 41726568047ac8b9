"""Queries that run a stream or write a store and return what they left.

Inputs are message files that Spark writes from the test tables into the
shared folder; every run uses new folders there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clamor.operators.mentions import dedupe, mention_facts, split_rejects, valid_rows
from clamor.operators import reports
from clamor.plans import endpoints, fixtures as fx
from clamor.schema import FACT_COLUMNS
from clamor.session import configure, work_folder
from clamor.sources.messages import decode, encode, file_stream, write_files
from clamor.sources.store import MentionStore
from clamor.streaming import job

BRAND = "acme"
# Longer than the time the test events cover, as files come in any order.
DELAY = "40 days"
ROWS_PER_FILE = 1_000_000
DAY = 1440


def few_batches(spark: SparkSession, folder: str) -> int:
    """Files per trigger that make about three batches of a folder."""
    return max(1, -(-len(spark.read.text(folder).inputFiles()) // 3))


def broken_lines(rows: DataFrame, folder: str) -> None:
    """Lines that are cut off in the middle."""
    lines = encode(rows).select(F.substring("value", 1, 25).alias("value"))
    lines.write.mode("append").text(folder)


def copies_of(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("likes") == 0)


def run_job(
    spark: SparkSession, folder: str, per_trigger: int, root: str, checkpoint: str, delay: str = DELAY
) -> StreamingQuery:
    arriving = file_stream(spark, folder, per_trigger)
    query = job.start(arriving, root, checkpoint, BRAND, trigger_seconds=None, delay=delay)
    query.awaitTermination()
    return query


def drained_store(spark: SparkSession, sf: str) -> MentionStore:
    """All raw mentions, copies of some in files of their own, broken lines."""
    folder = work_folder(spark, "messages")
    rows = fx.raw_mentions(spark, sf)
    write_files(rows, folder, ROWS_PER_FILE)
    write_files(copies_of(rows), folder, ROWS_PER_FILE)
    broken_lines(copies_of(rows), folder)
    root = work_folder(spark, "store")
    run_job(spark, folder, few_batches(spark, folder), root, work_folder(spark, "checkpoint"))
    return MentionStore(spark, root)


def stored(store: MentionStore) -> DataFrame:
    """All columns of the stored facts but the time of their batch."""
    return store.read("mentions").select(*FACT_COLUMNS).withColumns(
        {
            "ts": F.col("ts").cast("string"),
            "hashtags": F.array_join("hashtags", ","),
            "keywords": F.array_join("keywords", ","),
        }
    )


def stream_source(spark, sf):
    folder = work_folder(spark, "messages")
    write_files(fx.raw_mentions(spark, sf), folder, ROWS_PER_FILE)
    out, checkpoint = work_folder(spark, "table"), work_folder(spark, "checkpoint")
    query = (
        valid_rows(decode(file_stream(spark, folder, few_batches(spark, folder))))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("mention_id", "platform", "author", "text")


def stream_run(spark, sf):
    return stored(drained_store(spark, sf))


def stream_outputs(spark, sf):
    """Sizes and sums of every other table that the job has written."""
    store = drained_store(spark, sf)
    nodes, edges = store.graph()

    def part(name: str, rows: DataFrame, by: str, total: str) -> DataFrame:
        return rows.groupBy(F.lit(name).alias("output"), F.col(by).alias("part")).agg(
            F.count("*").alias("n"), F.sum(F.expr(total)).cast("long").alias("total")
        )

    parts = [
        part("rejects", store.read("rejects"), "reason", "length(mention_id)"),
        part("ids", store.read("ids").withColumn("all", F.lit("all")), "all", "length(mention_id)"),
        part("buckets", store.bucket_rows(), "sentiment", "mentions"),
        part("nodes", nodes, "label", "weight"),
        part("edges", edges, "rel", "weight"),
    ]
    stats = store.read("batch_stats").groupBy("brand").agg(
        F.sum("messages").alias("n"), F.sum("total_tokens").alias("total")
    )
    parts.append(stats.select(F.lit("batch_stats").alias("output"), F.col("brand").alias("part"), "n", "total"))
    return reduce(DataFrame.unionByName, parts)


def late_runs(spark: SparkSession, sf: str) -> tuple[MentionStore, list[StreamingQuery]]:
    """Three drains of one job that takes messages of the last day: the old ones, those of
    the last ten days but a tenth, and this tenth with copies of others."""
    rows = fx.raw_mentions(spark, sf)
    number = F.coalesce(F.substring("mention_id", 2, 20).cast("long"), F.lit(1))
    newest = rows.agg(F.max("ts")).scalar()
    recent = F.col("ts") >= newest - F.expr("INTERVAL 10 DAYS")
    kept_back = recent & (number % 10 == 0)
    folder, root = work_folder(spark, "messages"), work_folder(spark, "store")
    checkpoint, queries = work_folder(spark, "checkpoint"), []
    for part in (~recent, recent & ~kept_back, kept_back | (number % 10 == 1)):
        write_files(rows.where(part), folder, ROWS_PER_FILE)
        # One batch each, as files of one drain come in any order.
        queries.append(run_job(spark, folder, 100_000, root, checkpoint, "1 day"))
    return MentionStore(spark, root), queries


def stream_late(spark, sf):
    store, _ = late_runs(spark, sf)
    return stored(store)


def stream_restart(spark, sf):
    """The job ends, more files arrive, and it goes on from its checkpoint."""
    folder, root = work_folder(spark, "messages"), work_folder(spark, "store")
    checkpoint = work_folder(spark, "checkpoint")
    rows = fx.raw_mentions(spark, sf)
    early = F.col("batch_id") % 3 == 0
    write_files(rows.where(early), folder, ROWS_PER_FILE)
    run_job(spark, folder, few_batches(spark, folder), root, checkpoint)
    write_files(rows.where(~early), folder, ROWS_PER_FILE)
    write_files(copies_of(rows), folder, ROWS_PER_FILE)
    run_job(spark, folder, few_batches(spark, folder), root, checkpoint)
    store = MentionStore(spark, root)
    runs = store.read("batch_stats").select("run_id").distinct().agg(F.count("*")).scalar()
    return stored(store).withColumn("runs", runs)


def sink_idempotent(spark, sf):
    """Two overlapping batches; the first is applied again, once after its
    completion and once as if it had failed before."""
    rows = valid_rows(fx.raw_mentions(spark, sf))
    store = MentionStore(spark, work_folder(spark, "store"))
    first = rows.where(F.col("batch_id") % 2 == 0)
    job.process_batch(store, "run", BRAND, first, 0)
    job.process_batch(store, "run", BRAND, rows, 1)
    job.process_batch(store, "run", BRAND, first, 0)
    unfinished = MentionStore(spark, work_folder(spark, "store"))
    store.read("mentions").write.partitionBy("run_id", "batch_id").parquet(
        unfinished.path("mentions")
    )
    job.process_batch(unfinished, "run", BRAND, first, 0)
    return stored(unfinished)


def graph_seed(spark, sf):
    store = MentionStore(spark, work_folder(spark, "store"))
    store.load_history(mention_facts(fx.mentions(spark, sf), ("processed_at",)))
    store.rebuild_ledgers(BRAND)
    store.rebuild_ledgers(BRAND)
    kept, _ = store.write_graph_snapshot(per_label=90)
    return kept


def graph_replay(spark, sf):
    rows = valid_rows(fx.raw_mentions(spark, sf))
    store = MentionStore(spark, work_folder(spark, "store"))
    for batch, part in enumerate([F.col("batch_id") % 2 == 0, F.col("batch_id") % 2 == 1]):
        job.process_batch(store, "run", BRAND, rows.where(part), batch)
        job.process_batch(store, "run", BRAND, rows.where(part), batch)
    nodes, _ = store.graph()
    return nodes


def graph_folds(spark, sf):
    """Three batches; ledgers are folded into a base after each of the first two."""
    rows = valid_rows(fx.raw_mentions(spark, sf))
    store = MentionStore(spark, work_folder(spark, "store"))
    for batch in range(3):
        job.process_batch(store, "run", BRAND, rows.where(F.crc32("mention_id") % 3 == batch), batch)
        if batch < 2:
            store.fold_graph()
    nodes, _ = store.graph()
    return nodes


def stream_graph(spark, sf):
    """Part of the mentions is history; the stream brings the rest and some of
    it again; edges equal those of one pass over everything."""
    rows = fx.raw_mentions(spark, sf)
    folder, root = work_folder(spark, "messages"), work_folder(spark, "store")
    accepted, _ = split_rejects(rows.where(F.col("batch_id") % 4 == 0))
    MentionStore(spark, root).load_history(mention_facts(dedupe(accepted), ("processed_at",)))
    write_files(rows, folder, ROWS_PER_FILE)
    run_job(spark, folder, few_batches(spark, folder), root, work_folder(spark, "checkpoint"))
    _, edges = MentionStore(spark, root).graph()
    return edges


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own, for the settings of streaming state."""
    own = configure(spark.newSession())
    job.use_state_settings(own)
    return own


def count_live(spark: SparkSession, folder: str, out: str, checkpoint: str) -> None:
    own = stream_session(spark)
    arriving = valid_rows(decode(file_stream(own, folder, few_batches(spark, folder))))
    job.write_live_buckets(job.live_buckets(arriving, DELAY), out, checkpoint).awaitTermination()


def keep_live(spark: SparkSession, folder: str, out: str) -> None:
    """Live rows of a folder under a new checkpoint."""
    own = stream_session(spark)
    arriving = valid_rows(decode(file_stream(own, folder, few_batches(spark, folder))))
    job.write_live_buckets(
        job.live_mentions(arriving, DELAY), out, work_folder(spark, "checkpoint"), None, "append"
    ).awaitTermination()


def as_text(buckets: DataFrame) -> DataFrame:
    return buckets.withColumn("bucket", F.col("bucket").cast("string"))


def stream_buckets(spark, sf):
    """Live counts of the raw messages, copies and rejects among them."""
    folder, out = work_folder(spark, "messages"), work_folder(spark, "table")
    rows = fx.raw_mentions(spark, sf)
    write_files(rows, folder, ROWS_PER_FILE)
    write_files(copies_of(rows), folder, ROWS_PER_FILE)
    count_live(spark, folder, out, work_folder(spark, "checkpoint"))
    return as_text(job.read_live_buckets(spark, out))


def stream_buckets_runs(spark, sf):
    """Live counts over two checkpoints; each has files of its own."""
    out = work_folder(spark, "table")
    rows = fx.raw_mentions(spark, sf)
    for part in (F.col("batch_id") % 2 == 0, F.col("batch_id") % 2 == 1):
        folder = work_folder(spark, "messages")
        write_files(rows.where(part), folder, ROWS_PER_FILE)
        keep_live(spark, folder, out)
    return as_text(job.read_live_mentions(spark, out))


def stream_buckets_replayed(spark, sf):
    """Live counts over two checkpoints that both read the same files."""
    folder, out = work_folder(spark, "messages"), work_folder(spark, "table")
    write_files(fx.raw_mentions(spark, sf), folder, ROWS_PER_FILE)
    for _ in range(2):
        keep_live(spark, folder, out)
    return as_text(job.read_live_mentions(spark, out))


def stream_dedup(spark, sf):
    folder, out = work_folder(spark, "messages"), work_folder(spark, "table")
    rows = fx.raw_mentions(spark, sf)
    write_files(rows, folder, ROWS_PER_FILE)
    write_files(copies_of(rows), folder, ROWS_PER_FILE)
    arriving = file_stream(stream_session(spark), folder, few_batches(spark, folder))
    unique = job.unique_stream(valid_rows(decode(arriving)), DELAY)
    query = (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", work_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("mention_id", "platform", "text")


def crashed_store(spark: SparkSession, sf: str) -> MentionStore:
    """One run wrote the facts of a batch and ended, its checkpoint is lost; a new run
    gets all messages again, among them those of that batch."""
    rows = valid_rows(fx.raw_mentions(spark, sf))
    store = MentionStore(spark, work_folder(spark, "store"))
    accepted, _ = split_rejects(rows.where(F.col("batch_id") % 3 == 0))
    facts = mention_facts(dedupe(accepted), ("processed_at",))
    store.write_batch("mentions", facts, "lost", 0)
    store.rebuild_ledgers(BRAND, running="new")
    job.process_batch(store, "new", BRAND, rows, 0)
    return store


def stream_recovery(spark, sf):
    return as_text(crashed_store(spark, sf).bucket_rows())


def stream_recovery_stats(spark, sf):
    stats = crashed_store(spark, sf).read("batch_stats")
    return stats.select("run_id", "batch_id", "messages", "total_tokens", "opinions", "correct")


def loaded_history(spark: SparkSession, sf: str) -> MentionStore:
    """Two loads of history, neither of which replaces the other."""
    store = MentionStore(spark, work_folder(spark, "store"))
    facts = mention_facts(fx.mentions(spark, sf), ("processed_at",))
    for own in (F.col("brand") == BRAND, F.col("brand") != BRAND):
        store.load_history(facts.where(own))
        store.rebuild_ledgers(BRAND)
    return store


def history_load(spark, sf):
    return as_text(loaded_history(spark, sf).bucket_rows())


def history_graph(spark, sf):
    nodes, _ = loaded_history(spark, sf).graph()
    return nodes


def dated_store(spark: SparkSession, sf: str) -> MentionStore:
    """History in batches that follow each other in time: until ten days before the newest
    mention, until one and a half days before it, and the rest."""
    store = MentionStore(spark, work_folder(spark, "store"))
    facts = mention_facts(fx.mentions(spark, sf), ("processed_at",))
    newest = reports.latest(fx.mentions(spark, sf, even=False))
    ten, few = (newest - F.expr(f"INTERVAL {hours} HOURS") for hours in (240, 36))
    ts = F.col("ts")
    for part in (ts < ten, (ts >= ten) & (ts < few), ts >= few):
        store.load_history(facts.where(part))
    store.rebuild_ledgers(BRAND)
    return store


def store_trend(spark, sf):
    """The trend of the last day; only the last batch is opened."""
    now = reports.latest(fx.mentions(spark, sf, even=False))
    return as_text(endpoints.trend(dated_store(spark, sf), DAY, now))


def store_minutes(spark, sf):
    now = reports.latest(fx.mentions(spark, sf, even=False))
    return as_text(endpoints.minutes(dated_store(spark, sf), DAY, now))


def store_latest(spark, sf):
    return endpoints.messages(dated_store(spark, sf), 200).withColumns(
        {
            "ts": F.col("ts").cast("string"),
            "keywords": F.array_join("keywords", ","),
            "correct": F.col("correct").cast("string"),
        }
    )


def store_kpis(spark, sf):
    """KPIs from the records alone; authors are an estimate, held against the count."""
    store = dated_store(spark, sf)
    authors = store.read("mentions").agg(F.countDistinct("author")).scalar()
    off = F.abs(F.col("authors") - authors)
    row = endpoints.kpis(store, exact=False)
    return row.withColumn("authors_close", off <= 0.05 * authors).drop("authors")


def replayed_batch(spark, sf):
    """A second batch brings known messages only; its record tells when that was."""
    rows = valid_rows(fx.raw_mentions(spark, sf))
    store = MentionStore(spark, work_folder(spark, "store"))
    job.process_batch(store, "run", BRAND, rows, 0)
    job.process_batch(store, "run", BRAND, rows, 1)
    stats = store.read("batch_stats")
    state = reports.pipeline_state(stats).select("last_batch")
    return stats.select(
        "batch_id", "messages", F.col("processed_at").isNotNull().alias("timed"),
        state.scalar().alias("last_batch"),
    )


STREAM_QUERIES = {
    "stream_source": stream_source,
    "stream_run": stream_run,
    "stream_outputs": stream_outputs,
    "stream_late": stream_late,
    "graph_folds": graph_folds,
    "stream_buckets_replayed": stream_buckets_replayed,
    "stream_restart": stream_restart,
    "sink_idempotent": sink_idempotent,
    "graph_seed": graph_seed,
    "graph_replay": graph_replay,
    "stream_graph": stream_graph,
    "stream_buckets": stream_buckets,
    "stream_buckets_runs": stream_buckets_runs,
    "stream_dedup": stream_dedup,
    "stream_recovery": stream_recovery,
    "stream_recovery_stats": stream_recovery_stats,
    "history_load": history_load,
    "history_graph": history_graph,
    "replayed_batch": replayed_batch,
    "store_trend": store_trend,
    "store_minutes": store_minutes,
    "store_latest": store_latest,
    "store_kpis": store_kpis,
}
