"""What the state of the job, its ledgers and its graph base do between batches."""

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clamor.operators import graph, mentions as mn, reports
from clamor.plans import endpoints, fixtures as fx
from clamor.plans.stream_queries import BRAND, dated_store, late_runs, store_trend
from clamor.session import configure, work_folder
from clamor.sources.messages import decode, file_stream, write_files
from clamor.sources.store import MentionStore
from clamor.streaming import job
from conftest import SF


def rows(df):
    return sorted(map(repr, df.collect()))


def test_late_rows_are_counted_and_state_goes(spark):
    store, queries = late_runs(spark, SF)
    assert job.late_rows(queries[0]) == job.late_rows(queries[1]) == 0 < job.late_rows(queries[2])
    state = [p.stateOperators[0] for q in queries for p in q.recentProgress if p.stateOperators]
    assert sum(s.numRowsRemoved for s in state) > 0
    assert state[-1].numRowsTotal < max(s.numRowsTotal for s in state)
    # Rejected rows, with a time or without, are not lost to the state.
    assert store.read("rejects").count() > 0


def test_messages_without_a_time_are_rejected_and_not_late(spark):
    folder, root = work_folder(spark, "messages"), work_folder(spark, "store")
    timeless = fx.mentions(spark, SF).limit(20).withColumn("ts", F.lit(None).cast("timestamp"))
    write_files(fx.mentions(spark, SF).limit(50).unionByName(timeless), folder, 100)
    query = job.start(
        file_stream(spark, folder, 100), root, work_folder(spark, "checkpoint"), BRAND, None, "40 days"
    )
    query.awaitTermination()
    store = MentionStore(spark, root)
    assert [r.reason for r in store.read("rejects").select("reason").distinct().collect()] == ["ts missing"]
    assert store.read("rejects").count() == 20


@pytest.fixture(scope="module")
def batches(spark):
    """A store with two complete batches and a third that has only its facts."""
    raw = mn.valid_rows(fx.raw_mentions(spark, SF))
    store = MentionStore(spark, work_folder(spark, "store"))
    for batch in range(2):
        job.process_batch(store, "run", BRAND, raw.where(F.crc32("mention_id") % 2 == batch).limit(300), batch)
    accepted, _ = mn.split_rejects(raw.limit(40).withColumn("mention_id", F.concat(F.lit("x"), "mention_id")))
    facts = mn.mention_facts(mn.dedupe(accepted), ("processed_at",))
    store.write_batch("mentions", facts, "run", 2)
    return store


def test_known_ids_open_no_fact_file(spark, batches):
    files = batches.known_ids("run", 9, ledgers_whole=True).inputFiles()
    assert files and all("/ids/" in f for f in files)
    # Without that knowledge only the facts that lack a ledger are opened as well.
    some = batches.known_ids("run", 9)
    facts = [f for f in some.inputFiles() if "/mentions/" in f]
    assert some.count() == batches.read("mentions").count()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert facts and "batch_id#" in plan and "PartitionFilters" in plan


def test_compaction_keeps_unfinished_batches_apart(spark, batches):
    small = MentionStore(spark, work_folder(spark, "store"))
    batches.compact(small, "compacted")
    for table in ("mentions", "ids", "rejects"):
        assert small.read(table).count() == batches.read(table).count()
        assert rows(small.read_complete(table).drop("run_id", "batch_id")) == rows(
            batches.read_complete(table).drop("run_id", "batch_id")
        )
    assert ("run", 2) in small.batches("mentions")
    small.rebuild_ledgers(BRAND)
    total = small.read("mentions").count()
    assert small.bucket_rows().agg(F.sum("mentions")).first()[0] == total
    assert small.read_complete("mentions").count() == small.read("ids").count() == total


def test_graph_of_base_and_tail(spark, batches):
    store = MentionStore(spark, work_folder(spark, "store"))
    raw = mn.valid_rows(fx.raw_mentions(spark, SF)).persist()
    assert not store.fold_graph()
    for batch in range(3):
        job.process_batch(store, "run", BRAND, raw.where(F.crc32("mention_id") % 3 == batch), batch)
        if batch < 2:
            assert store.fold_graph() and not store.fold_graph()
    plain = graph.merge_elements(store.read_complete("graph"))
    assert rows(store.graph_elements()) == rows(plain)
    base, held = store.graph_base()
    assert held == {"run": 1}
    # Of the ledgers only the partition behind the base passes the partition filters.
    plan = store.graph_tail(held)._jdf.queryExecution()
    scans = plan.executedPlan().toString()
    assert "(batch_id#" in scans[scans.index("PartitionFilters") :]
    read = store.graph_tail(held).select("batch_id").distinct().collect()
    assert [r.batch_id for r in read] == [2]
    # A base tells its batches by the last of each run: history is numbered upwards only.
    assert store.load_history(store.read("mentions").limit(1), 4) == 4
    with pytest.raises(ValueError):
        store.load_history(store.read("mentions").limit(1), 3)


def test_many_special_ids_are_left_to_spark(spark, monkeypatch):
    raw = fx.raw_mentions(spark, SF).select("mention_id", "ts", "author", "text").persist()
    known = raw.where(F.col("ts") < F.lit("2024-01-10")).select("mention_id")
    few = rows(mn.new_mentions(raw, known))
    hinted = mn.new_mentions(raw, known)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(mn, "SPECIAL", 0)
    assert rows(mn.new_mentions(raw, known)) == few
    free = mn.new_mentions(raw, known)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hinted and "broadcast" not in free


def test_unique_rows_are_not_shuffled(spark):
    """With automatic broadcasts off, only first copies of repeated ids meet an exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = mn.valid_rows(fx.mentions(spark, SF).select("mention_id", "ts", "text")).persist()
        plan = mn.new_mentions(raw, raw.limit(5))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
        single = plan[: plan.index("LeftSemi")]
        assert "LeftAnti" in single and "Exchange hashpartitioning" not in single.split("LeftAnti")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_open_the_batches_of_their_window(spark):
    store = dated_store(spark, SF)
    newest = reports.latest(store.read("mentions"))
    for df in (endpoints.trend(store, 1440, newest), endpoints.minutes(store, 1440, newest)):
        assert "dynamicpruning" in plan(df)
    found = store.read_since("mentions", "last_ts", newest).select("batch_id").distinct().collect()
    assert [r.batch_id for r in found] == [2]
    # Last processed: of the newest mention's batch and the one before it.
    last = store.newest_mentions(1)
    assert sorted(r.batch_id for r in last.select("batch_id").distinct().collect()) == [1, 2]
    assert "dynamicpruning" in plan(last)
    # Records without times, as older ones are, prune nothing.
    stats = store.read("batch_stats").withColumn("last_ts", F.lit(None).cast("timestamp"))
    older = MentionStore(spark, work_folder(spark, "store"))
    for table, df in (("mentions", store.read("mentions")), ("batch_stats", stats)):
        df.write.partitionBy("run_id", "batch_id").parquet(older.path(table))
    assert older.read_since("mentions", "last_ts", newest).count() == store.read("mentions").count()


def test_reports_over_a_compacted_store(spark):
    store, small = dated_store(spark, SF), MentionStore(spark, work_folder(spark, "store"))
    store.compact(small, "compacted")
    smaller = MentionStore(spark, work_folder(spark, "store"))
    small.compact(smaller, "again")
    newest = reports.latest(store.read("mentions"))
    for other in (small, smaller):
        for ask in (
            lambda s: endpoints.trend(s, 1440, newest),
            lambda s: endpoints.minutes(s, 1440, newest),
            lambda s: endpoints.messages(s, 30),
            lambda s: endpoints.kpis(s, exact=False),
            lambda s: endpoints.health(s, BRAND).select("mentions"),
        ):
            assert rows(ask(other)) == rows(ask(store))


def test_kpis_of_records_open_no_fact_file(spark):
    store = dated_store(spark, SF)
    got, exact = endpoints.kpis(store, exact=False), endpoints.kpis(store)
    assert all("/batch_stats/" in f for f in got.inputFiles())
    got, exact = got.first().asDict(), exact.first().asDict()
    assert abs(got.pop("authors") / exact.pop("authors") - 1) <= 0.05
    assert got == exact
    none = MentionStore(spark, work_folder(spark, "store"))
    assert endpoints.kpis(none, exact=False).first() == endpoints.kpis(none).first()
    assert endpoints.health(none, BRAND).first().mentions == 0


def test_a_table_not_written_yet_is_known_to_be_empty(spark):
    store = MentionStore(spark, work_folder(spark, "store"))
    empty = store.read("mentions")
    assert empty.count() == 0 and [f.name for f in empty.schema][-2:] == ["run_id", "batch_id"]
    plan = empty._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation <empty>")


def test_events_are_spread_for_scoring_only(spark, monkeypatch):
    """The newest time of a dated store comes from the events as they lie."""
    spread, dealt = fx.spread, []

    def watched(df, key):
        dealt.append(key)
        return spread(df, key)

    monkeypatch.setattr(fx, "spread", watched)
    assert store_trend(spark, SF).count() > 0
    assert dealt == ["event_id"]
    as_they_lie = fx.mentions(spark, SF, even=False)
    assert dealt == ["event_id"] and rows(as_they_lie) == rows(fx.mentions(spark, SF))


def test_ledgers_of_two_runs_with_equal_batch_numbers(spark):
    """Groups are told apart by batch alone, as each run is worked on by itself."""
    facts = mn.mention_facts(fx.mentions(spark, SF).limit(60), ("processed_at",)).localCheckpoint()
    store = MentionStore(spark, work_folder(spark, "store"))
    for run, own in (("a", F.col("brand") == BRAND), ("b", F.col("brand") != BRAND)):
        store.write_batch("mentions", facts.where(own), run, 0)
        store.write_batch("mentions", facts.where(own & (F.col("likes") % 2 == 0)), run, 1)
    store.rebuild_ledgers(BRAND)
    keys = ["run_id", "batch_id"]
    stored = store.read("mentions")
    want = stored.groupBy(*keys).count()
    assert rows(store.read("ids").groupBy(*keys).count()) == rows(want)
    assert rows(store.read("batch_stats").select(*keys, F.col("messages").alias("count"))) == rows(want)
    assert rows(store.read("buckets").select("bucket", "sentiment", "mentions", *keys)) == rows(
        reports.buckets(stored, *keys).select("bucket", "sentiment", "mentions", *keys)
    )
    names = store.read("graph").columns
    assert rows(store.read("graph")) == rows(graph.graph_elements(stored, *keys).select(*names))


def wire(folder, *rows):
    """A JSON-lines file of (id, time, author)."""
    lines = [
        json.dumps({"mention_id": i, "ts": ts, "text": "bueno", "author": author, "brand": BRAND, "platform": "p"})
        for i, ts, author in rows
    ]
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / f"{uuid.uuid4().hex}.json").write_text("\n".join(lines) + "\n")


def test_messages_without_a_time_pass_by_the_state(spark):
    """Each of them is rejected, however many copies and whatever the watermark is, and
    none takes the place of a message with a time."""
    folder, root = work_folder(spark, "messages"), work_folder(spark, "store")
    checkpoint = work_folder(spark, "checkpoint")
    late = []
    for given in (
        [("a", None, "x"), ("a", None, "x"), ("b", "2024-03-09T00:00:00Z", "x"), ("c", "2024-03-09T00:00:00Z", None)],
        [("a", "2024-03-09T00:00:00Z", "x"), ("a", "2024-03-09T00:00:00Z", "x"), ("b", None, "x")],
        # The watermark is beyond the first time; "c" was rejected and its copy is dropped.
        [("b", None, "x"), ("c", "2024-03-09T00:00:00Z", "x"), ("d", "2024-03-01T00:00:00Z", "x")],
    ):
        wire(folder, *given)
        query = job.start(file_stream(spark, folder, 100), root, checkpoint, BRAND, None, "1 day")
        query.awaitTermination()
        late.append(job.late_rows(query))
    store = MentionStore(spark, root)
    assert sorted(r.mention_id for r in store.read("mentions").collect()) == ["a", "b"]
    rejected = sorted((r.mention_id, r.reason) for r in store.read("rejects").collect())
    assert rejected == [("a", "ts missing")] * 2 + [("b", "ts missing")] * 2 + [("c", "author missing")]
    assert late == [0, 0, 1]


def test_the_job_keeps_one_state_on_disk_and_parses_once(spark):
    """State of the heap and two passes over the ids ended in a heap that was too small."""
    own = configure(spark.newSession())
    folder, root = work_folder(spark, "messages"), work_folder(spark, "store")
    wire(folder, ("a", "2024-03-09T00:00:00Z", "x"), ("a", "2024-03-09T00:00:00Z", "x"))
    query = job.start(
        file_stream(own, folder, 100), root, work_folder(spark, "checkpoint"), BRAND, None, "1 day"
    )
    query.awaitTermination()
    states = next(p for p in query.recentProgress if p.numInputRows).stateOperators
    assert len(states) == 1 and states[0].numRowsTotal == 1
    assert any(name.startswith("rocksdb") for name in states[0].customMetrics)
    plan = query._jsq.explainInternal(True)
    assert plan.split("== Physical Plan ==")[-1].count("from_json(") == 1


def test_live_streams_tell_timeless_messages_by_id(spark):
    """The key of its own is that of the job only."""
    own = configure(spark.newSession())
    folder, out = work_folder(spark, "messages"), work_folder(spark, "table")
    wire(folder, ("a", None, "x"), ("a", None, "x"), ("b", "2024-03-09T00:00:00Z", "x"))
    unique = job.unique_stream(decode(file_stream(own, folder, 100)), "1 day")
    query = unique.writeStream.format("parquet").option(
        "checkpointLocation", work_folder(spark, "checkpoint")
    ).trigger(availableNow=True).start(out)
    query.awaitTermination()
    assert sorted(r.mention_id for r in spark.read.parquet(out).collect()) == ["a", "b"]
