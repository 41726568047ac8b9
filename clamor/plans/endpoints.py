"""What a dashboard asks a store, one function per question.

Each returns DataFrames over the stored tables; nothing is scored again.  Times
are relative to ``as_of``, by default the current time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.functions import sql
from clamor.operators import graph as gr
from clamor.operators import reports
from clamor.operators.session_graph import session_graph
from clamor.sources.store import MentionStore


def health(store: MentionStore, default_brand: str) -> DataFrame:
    return reports.health(store.read("batch_stats"), None, default_brand)


def kpis(store: MentionStore, exact: bool = True) -> DataFrame:
    """The KPIs; if not ``exact``, from the batch records, with authors estimated."""
    if exact:
        return reports.kpi_ratios(reports.kpis(store.read_complete("mentions")))
    return reports.kpi_ratios(reports.kpis_of_batches(store.read("batch_stats")))


def trend(store: MentionStore, minutes: int = 30, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return reports.trend(store.bucket_rows(reports.window_start(now, minutes)), now, minutes)


def minutes(store: MentionStore, window: int = 20, as_of: Column | None = None) -> DataFrame:
    """Buckets of the last minutes, counted from the facts."""
    now = F.current_timestamp() if as_of is None else as_of
    facts = store.read_since("mentions", "last_ts", reports.window_start(now, window))
    return reports.minute_buckets(facts, now, window)


def graph(store: MentionStore, limit: int = 140) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the slice; the slice itself is at most 1000 rows."""
    nodes, edges = store.graph()
    chosen = gr.slice_nodes(nodes, limit)
    return chosen, gr.slice_edges(edges, chosen.select("node_id"))


def messages(store: MentionStore, limit: int = 30) -> DataFrame:
    return reports.latest_mentions(store.newest_mentions(limit), limit)


def accuracy(store: MentionStore) -> tuple[DataFrame, DataFrame]:
    """(confusion matrix, accuracy per class)."""
    facts = store.read_complete("mentions")
    return reports.confusion(facts), reports.class_accuracy(facts)


def visible(store: MentionStore, kinds: list[str], top: int = 30) -> DataFrame:
    """The nodes to draw, with their display size."""
    nodes, _ = store.graph()
    return gr.scaled(gr.visible_nodes(nodes, kinds, top), gr.NODE_CONSTANT)


def neighbourhood(store: MentionStore, centre: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) around a node."""
    return gr.neighbourhood(*store.graph(), centre)


def session(store: MentionStore, brand: str, keep: int | None = None) -> DataFrame:
    """Session graph of the stored mentions of a brand."""
    own = store.read_complete("mentions").where(F.col("brand") == brand)
    return session_graph(own, brand, keep)


def work(store: MentionStore, limit: int = 40) -> tuple[DataFrame, DataFrame]:
    """(newest batches, totals over all batches)."""
    stats = store.read("batch_stats")
    return reports.batch_list(stats, limit), reports.batch_totals(stats)


def register_views(store: MentionStore) -> None:
    """Temporary views of the store for SQL: mentions, sentiment_buckets,
    batch_stats, graph_nodes, graph_edges, kpis and accuracy, and the scoring functions."""
    sql.register(store.spark)
    facts = store.read_complete("mentions")
    nodes, edges = store.graph()
    views = {
        "mentions": facts,
        "sentiment_buckets": store.bucket_rows(),
        "batch_stats": store.read("batch_stats"),
        "graph_nodes": nodes,
        "graph_edges": edges,
        "kpis": reports.kpis(facts),
        "accuracy": reports.accuracy_shares(facts),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
