"""Shape of the physical plans: what must not appear in any of them."""

import re

import pytest

from clamor import session
from clamor.operators import graph as graph_module
from clamor.operators import session_graph as session_module
from clamor.plans import fixtures as fx
from clamor.plans import queries as query_module
from clamor.plans.queries import QUERIES
from clamor.plans.stream_queries import STREAM_QUERIES
from conftest import SF

BATCH = [k for k in QUERIES if k not in STREAM_QUERIES]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables that a query writes on its way."""
    plans = []

    def watched(df):
        plans.append(plan_of(df))
        return session.materialise(df)

    for module in (graph_module, session_module, query_module):
        monkeypatch.setattr(module, "materialise", watched)
    return plans


@pytest.mark.parametrize("key", BATCH)
def test_plan(spark, key, written):
    last = plan_of(QUERIES[key](spark, SF))
    plan = "\n".join([*written, last])
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert operator not in plan, operator
    for line in plan.split("\n"):
        # Text work belongs in projections; in a filter it would be done twice.
        if re.match(r"[\s:+\-*()\d]*Filter", line):
            assert "regexp_extract_all" not in line


def test_no_shuffle_for_scores(spark):
    plan = plan_of(QUERIES["score_documents"](spark, SF))
    assert set(re.findall(r"Exchange \w+", plan)) <= {"Exchange hashpartitioning"}
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM")


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["health"](spark, SF))
    assert "props" not in plan and "value" not in re.findall(r"ReadSchema: \S+", plan)[0]


def test_edges_of_a_slice_are_not_shuffled(spark, tmp_path):
    """Also with automatic broadcast off, as with a large node table."""
    nodes = spark.range(100).selectExpr("concat('n', id) node_id", "'MARCA' label", "id weight")
    edges = spark.range(1000).selectExpr(
        "concat('n', id % 100) src", "concat('n', id % 7) dst", "'r' rel", "id weight"
    )
    edges.write.parquet(f"{tmp_path}/edges")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chosen = graph_module.slice_nodes(nodes, 10).select("node_id")
        plan = plan_of(graph_module.slice_edges(spark.read.parquet(f"{tmp_path}/edges"), chosen))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_one_pass_for_the_graph(spark):
    from clamor.operators import graph
    from clamor.plans.queries import facts

    plan = plan_of(graph.graph_elements(facts(spark, SF)))
    assert plan.count("FileScan") == 1


def test_spread_leaves_large_inputs_alone(spark):
    many = spark.range(0, 1000, 1, 64)
    assert fx.spread(many, "id") is many


def test_edges_among_kept_nodes_are_not_shuffled(spark, tmp_path, monkeypatch):
    """With automatic broadcasts off the counted set is still sent, up to its bound."""
    edges = spark.range(1000).selectExpr("concat('n', id) AS src", "concat('n', id + 1) AS dst")
    spark.range(50).selectExpr("concat('n', id) AS node_id").write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(graph_module.edges_among_kept(edges, kept))
        assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan
        monkeypatch.setattr(graph_module, "KEPT_SENT", 10)
        assert "BroadcastHashJoin" not in plan_of(graph_module.edges_among_kept(edges, kept))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_spread_deals_few_crowded_splits(spark, monkeypatch):
    """Splits enough for all cores, but one of them holds all rows."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    crowded = spark.range(0, 10_000, 1, 8).where("id < 1250")
    dealt = fx.spread(crowded, "id")
    assert dealt.rdd.getNumPartitions() == 13
    assert max(dealt.rdd.glom().map(len).collect()) < 300 and dealt.count() == 1250


def test_session_elements_are_not_sorted(spark, tmp_path):
    """One row per message and element: counted in hash tables, whatever their number."""
    query_module.facts(spark, SF).write.parquet(str(tmp_path / "facts"))
    elements = session_module.session_elements(spark.read.parquet(str(tmp_path / "facts")))
    plan = plan_of(elements)
    assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 2


def test_graph_elements_are_compiled(spark, tmp_path):
    query_module.facts(spark, SF).write.parquet(str(tmp_path / "facts"))
    plan = plan_of(graph_module.graph_elements(spark.read.parquet(str(tmp_path / "facts"))))
    assert "lambda" not in plan


def test_written_facts_are_read_in_small_splits(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == session.SETTINGS[
        "spark.sql.files.maxPartitionBytes"
    ] == "16m"
