"""Skew, replay, split and empty-input behaviour of the table operators."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clamor.functions import lexicon as lx
from clamor.functions.text import with_tokens
from clamor.operators import detail, graph, mentions as mn, ordering, reports
from clamor.operators.session_graph import session_graph
from clamor.plans import endpoints, fixtures as fx
from clamor.schema import MESSAGE
from clamor.session import work_folder
from clamor.sources import messages as ms
from clamor.sources.store import MentionStore
from clamor.streaming import job
from conftest import SF


@pytest.fixture(scope="module")
def facts(spark):
    rows = mn.mention_facts(fx.mentions(spark, SF), ("batch_id", "processed_at"))
    path = work_folder(spark, "facts")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(facts):
    return facts.limit(0)


def rows(df):
    return sorted(map(repr, df.collect()))


def messages(spark, *given):
    base = {f.name: None for f in MESSAGE}
    return spark.createDataFrame([{**base, **g} for g in given], MESSAGE)


def test_hot_id_is_one_row(spark):
    """A third of all rows carry one id."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), "id")).alias("mention_id"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
        F.col("id").cast("string").alias("text"),
    )
    kept = mn.dedupe(df)
    assert kept.count() == 6001
    assert kept.where("mention_id = 'hot'").first().text == "0"


def test_dedupe_spreads_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit("x").alias("mention_id"), F.col("id").alias("ts"))
    plan = mn.dedupe(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_defaults_and_rejects(spark):
    ts = fx.mentions(spark, SF).first().ts
    good = {"mention_id": "a", "text": "", "ts": ts, "brand": "b", "platform": "p", "author": "u"}
    df = messages(
        spark, good, {**good, "mention_id": None}, {**good, "text": None}, {**good, "ts": None},
        {**good, "brand": None}, {**good, "expected": "OTHER"}, {**good, "expected": "NEUTRAL"},
    )
    accepted, rejected = mn.split_rejects(df)
    assert accepted.count() == 2
    assert sorted(r.reason for r in rejected.collect()) == [
        "brand missing", "expected not a class", "mention_id missing", "text missing", "ts missing",
    ]
    row = mn.apply_defaults(accepted.limit(1)).first()
    assert (row.source, row.lang, row.hashtags, row.likes) == ("desconocida", "es", [], 0)


def test_dedupe_orders_only_repeated_rows(spark):
    """Rows of ids that occur once meet no sort and are not shuffled with their columns."""
    df = fx.raw_mentions(spark, SF).select("mention_id", "ts", "text")
    plan = mn.dedupe(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan
    none = messages(spark, {"mention_id": None, "text": "x"}, {"mention_id": None, "text": "y"})
    assert [r.text for r in mn.dedupe(none).collect()] == ["x"]


def test_known_ids(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("c",)], "mention_id string")
    known = spark.createDataFrame([("b",), ("z",), ("b",)], "mention_id string")
    left = mn.without_known(batch, known)
    assert sorted(r.mention_id for r in left.collect()) == ["a", "c"]


def test_history_is_not_shuffled_for_a_small_batch(spark):
    batch = spark.range(10).select(F.concat(F.lit("a"), "id").alias("mention_id"))
    path = work_folder(spark, "known")
    spark.range(1000).select(F.concat(F.lit("a"), "id").alias("mention_id")).write.parquet(path)
    batch = batch.persist()
    assert batch.count() == 10
    plan = mn.without_known(batch, spark.read.parquet(path))
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.split("\n") if "FileScan" in line)
    before = text[: text.index(scan)].split("\n")
    nearest = next(line for line in reversed(before) if "Exchange" in line or "BroadcastHashJoin" in line)
    assert "BroadcastHashJoin" in nearest


def test_malformed_messages(spark):
    df = spark.createDataFrame(
        [('{"mention_id":"a","text":"x","likes":3}',), ('{"mention_id":"b"',), ("",), (None,),
         ('{"mention_id":"c","text":"y","likes":"many"}',), ("[1,2]",)],
        "value string",
    )
    got = {r.mention_id: r.likes for r in mn.valid_rows(ms.decode(df)).collect()}
    assert got == {"a": 3, "c": None}


def test_round_trip(spark):
    base = fx.mentions(spark, SF).select([f.name for f in MESSAGE])
    base = base.withColumn("ts", F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 0, 0, 0.123456)"))
    assert rows(ms.decode(ms.encode(base)).select(base.columns)) == rows(base)


def test_topic_needs_its_package(spark):
    with pytest.raises(AnalysisException):
        ms.topic_stream(spark, "localhost:1", "mentions")


def test_node_and_edge_forms_agree(facts):
    nodes, edges = graph.split_elements(graph.graph_elements(facts))
    assert rows(nodes.select(*graph.NODE_KEYS, *graph.NODE_SUMS)) == rows(graph.graph_nodes(facts))
    assert rows(edges.select(*graph.EDGE_KEYS, *graph.EDGE_SUMS)) == rows(graph.graph_edges(facts))
    joined = graph.aggregate_edges(graph.edge_contributions_joined(facts))
    assert rows(joined) == rows(graph.graph_edges(facts))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_give_one_graph(spark, facts, seed):
    parts = random.Random(seed).randint(2, 6)
    split = facts.withColumn("part", F.pmod(F.hash("mention_id", F.lit(seed)), F.lit(parts)))
    ledger = graph.graph_elements(split, "part")
    assert rows(graph.merge_elements(ledger)) == rows(graph.graph_elements(facts))
    edge_parts = graph.aggregate_edges(graph.edge_contributions(split, "part"), "part")
    assert rows(graph.merge_edges(edge_parts)) == rows(graph.graph_edges(facts))
    counters = reports.batch_counters(split, ("part",))
    assert rows(reports.batch_totals(counters)) == rows(
        reports.batch_totals(reports.batch_counters(facts))
    )


def test_top_nodes_against_sorting(facts):
    nodes = graph.graph_nodes(facts)
    got = {r.node_id for r in graph.top_nodes(nodes, 7).collect()}
    want = set()
    by_label = {}
    for r in nodes.collect():
        by_label.setdefault(r.label, []).append(r)
    for label, members in by_label.items():
        members.sort(key=lambda r: (-r.weight, -abs(r.score_sum) / r.weight, r.node_id))
        want |= {r.node_id for r in (members if label in graph.ALWAYS_KEPT else members[:7])}
    assert got == want


def test_visible_and_scaled_edges(spark):
    nodes = spark.createDataFrame(
        [(f"MARCA:{i}", "MARCA", str(i), 1) for i in range(3)]
        + [(f"PALABRA:{i}", "PALABRA", str(i), i) for i in range(9)],
        "node_id string, label string, name string, weight bigint",
    )
    shown = graph.visible_nodes(nodes, ["MARCA", "PALABRA"], 5)
    assert sorted(r.node_id for r in shown.collect()) == [
        "MARCA:0", "MARCA:1", "MARCA:2", "PALABRA:7", "PALABRA:8",
    ]
    assert graph.visible_nodes(nodes, ["MARCA", "PALABRA"], 2).count() == 3
    same = graph.scaled(nodes.where("label = 'MARCA'"), 0.6)
    assert {r.size for r in same.collect()} == {0.6}


def test_slice_limits(facts):
    with pytest.raises(ValueError):
        graph.slice_nodes(graph.graph_nodes(facts), 9)
    with pytest.raises(ValueError):
        reports.latest_mentions(facts, 201)
    with pytest.raises(ValueError):
        reports.trend(facts, F.lit(None), 1441)


def test_empty_tables(spark, empty):
    row = reports.kpi_ratios(reports.kpis(empty)).first()
    assert (row.total, row.accuracy, row.pct_positive, row.avg_score) == (0, 0.0, 0.0, None)
    stats = reports.batch_counters(empty).withColumn("brand", F.lit("b"))
    state = reports.health(stats, empty, "acme").first()
    assert (state.brand, state.last_batch, state.mentions) == ("acme", -1, 0)
    totals = reports.batch_totals(stats).first()
    assert tuple(totals) == (0, 0, 0, 0, 0, 0)
    assert reports.work_ratio(stats).first().work_ratio is None
    assert graph.graph_elements(empty).count() == 0
    assert session_graph(empty, keep=5).count() == 0
    assert reports.trend(reports.buckets(empty), F.current_timestamp()).count() == 0


def test_bucket_window_starts_at_a_whole_minute(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:05", "NEUTRAL"), ("2024-01-01 10:00:50", "NEUTRAL"),
         ("2024-01-01 10:20:30", "NEUTRAL")],
        "ts string, sentiment string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    now = F.lit("2024-01-01 10:20:30").cast("timestamp")
    got = reports.minute_buckets(df, now, 20).orderBy("bucket").collect()
    assert [r.mentions for r in got] == [2, 1]


def test_duplicates_change_nothing(facts):
    doubled = facts.unionByName(facts)
    assert rows(session_graph(doubled)) == rows(session_graph(facts))


def test_sorts(spark, facts):
    got = [r.score for r in ordering.global_sort(facts, F.col("score"), "mention_id").collect()]
    assert got == sorted(got)
    down = ordering.global_sort(facts, F.col("score"), "mention_id", descending=True).collect()
    keys = [(-r.score, r.mention_id) for r in down]
    assert keys == sorted(keys)
    parts = [spark.createDataFrame([(x,) for x in p], "x int") for p in ([1, 5, 9], [2, 3], [4, 8])]
    merged = ordering.merge_sorted([*parts, parts[0].limit(0)], F.col("x"), "x")
    assert [r.x for r in merged.collect()] == [1, 2, 3, 4, 5, 8, 9]


def test_store_replay_and_compaction(spark):
    raw = mn.valid_rows(fx.raw_mentions(spark, SF))
    store = MentionStore(spark, work_folder(spark, "store"))
    assert store.read("mentions").count() == 0
    half = raw.where(F.col("likes") < 25)
    assert job.process_batch(store, "run", "acme", half, 0)
    before = rows(store.read("graph")), rows(store.read("mentions"))
    assert job.process_batch(store, "run", "acme", half, 0) is None
    assert (rows(store.read("graph")), rows(store.read("mentions"))) == before
    assert job.process_batch(store, "run", "acme", raw, 1)
    assert not job.process_batch(store, "run", "acme", raw.limit(0), 2)
    assert store.read("rejects").where("batch_id = 1").count() > 0

    # The same batch number under another run is another batch.
    assert job.process_batch(store, "other", "acme", raw, 0)
    assert store.read("mentions").where("run_id = 'other'").count() == 0

    small = MentionStore(spark, work_folder(spark, "store"))
    store.compact(small, "compacted")
    for mine, theirs in zip(store.graph(), small.graph()):
        assert rows(mine) == rows(theirs)
    assert rows(store.bucket_rows()) == rows(small.bucket_rows())
    assert small.is_complete("run", 1)
    assert store.read("mentions").count() == small.read("mentions").count()
    assert rows(reports.buckets(store.read("mentions"))) == rows(store.bucket_rows())


def test_failed_seed_does_not_stop_the_stream(spark, monkeypatch):
    def broken(self):
        raise RuntimeError("no store")

    monkeypatch.setattr(MentionStore, "rebuild_ledgers", broken)
    folder, root = work_folder(spark, "messages"), work_folder(spark, "store")
    ms.write_files(fx.mentions(spark, SF), folder, 1000)
    query = job.start(
        ms.file_stream(spark, folder, 100), root, work_folder(spark, "checkpoint"), "acme", None
    )
    query.awaitTermination()
    assert MentionStore(spark, root).read("mentions").count() == fx.mentions(spark, SF).count()


def test_endpoints_and_views(spark):
    raw = mn.valid_rows(fx.raw_mentions(spark, SF))
    store = MentionStore(spark, work_folder(spark, "store"))
    assert endpoints.health(store, "acme").first().last_batch == -1
    summary = job.process_batch(store, "run", "globex", raw, 7)
    stored = store.read("mentions").count()
    nodes, edges = store.graph()
    assert (summary["messages"], summary["nodes"], summary["edges"]) == (
        stored, nodes.count(), edges.count(),
    )
    state = endpoints.health(store, "acme").first()
    assert (state.brand, state.last_batch, state.mentions) == ("globex", 7, stored)
    assert endpoints.kpis(store).first().total == stored
    newest = reports.latest(store.read("mentions"))
    points = endpoints.trend(store, 1440, newest).collect()
    assert points and all(p.total == p.POSITIVO + p.NEUTRAL + p.NEGATIVO for p in points)
    chosen, links = endpoints.graph(store, 20)
    ids = {r.node_id for r in chosen.collect()}
    assert len(ids) == 20 and all({e.src, e.dst} <= ids for e in links.collect())
    assert endpoints.messages(store, 5).count() == 5
    matrix, per_class = endpoints.accuracy(store)
    assert sum(r.total for r in matrix.collect()) == stored
    assert {r.expected for r in per_class.collect()} == set(reports.CLASSES)
    listed, totals = endpoints.work(store)
    assert listed.count() == 1 and totals.first().messages == stored
    endpoints.register_views(store)
    counted = spark.sql("SELECT sum(n) AS n FROM (SELECT source, platform, count(*) AS n FROM mentions GROUP BY ALL)")
    assert counted.first().n == stored
    assert spark.sql("SELECT total FROM kpis").first().total == stored


def test_filters_parse_no_value_again(spark, tmp_path):
    spark.createDataFrame([('{"mention_id":"a","text":"t"}',), ("{",), ("",), (None,)], "value string").write.text(
        f"{tmp_path}/lines"
    )
    got = ms.decode(spark.read.text(f"{tmp_path}/lines"))
    kept = mn.valid_rows(got).where("ts IS NULL")
    assert kept._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert [(r.mention_id, r.text) for r in kept.collect()] == [("a", "t")]
    # A value without a message gives a row of nulls.
    assert got.where("mention_id IS NULL AND text IS NULL AND hashtags IS NULL").count() == 3


def test_clauses_of_texts_full_of_breaks(spark):
    texts = ["", None, "bueno", ", , pero", "casa, rojo. pero verde: sin embargo, azul aunque", "pero " * 50 + "gato, " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    want = []
    for r in with_tokens(df, "text").collect():
        clause = depth = 0
        for pos, token in enumerate(r.tokens or []):
            clause += token in lx.clause_breaks
            depth += token in lx.contrasts
            want.append((r.i, pos, token, clause, depth))
    found = detail.clauses(df, ["i"])
    assert sorted(map(tuple, found.select("i", "pos", "token", "clause", "depth").collect())) == sorted(want)
    # Tokens are neither written into text with their places nor read out of it again.
    assert "substring_index" not in found._jdf.queryExecution().executedPlan().toString()
