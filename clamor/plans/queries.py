"""Every operator as a query over the test tables.

Lists come out as joined strings and computed numbers are rounded, so that
results compare by value across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clamor.functions import sql
from clamor.functions import text as tx
from clamor.functions.scoring import with_scores
from clamor.operators import detail, graph, mentions as mn, ordering, reports
from clamor.operators.session_graph import session_graph
from clamor.plans import fixtures as fx
from clamor.plans.stream_queries import STREAM_QUERIES
from clamor.session import materialise
from clamor.sources.messages import decode, encode, union_sources

BRAND = "acme"
DAY = 1440
KEY = ["mention_id"]
Query = Callable[[SparkSession, str], DataFrame]


def joined(name: str):
    return F.array_join(name, ",").alias(name)


# --------------------------------------------------------------------------
# Shared inputs
# --------------------------------------------------------------------------


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return mn.mention_facts(fx.mentions(spark, sf), ("batch_id", "processed_at"))


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return reports.batch_counters(facts(spark, sf)).withColumn("brand", F.lit(BRAND))


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.with_sentiment(graph.graph_nodes(facts(spark, sf)))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.with_sentiment(graph.graph_edges(facts(spark, sf)))


def stored_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return graph.build_graph(facts(spark, sf))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --------------------------------------------------------------------------
# A. Rows in and out
# --------------------------------------------------------------------------


def wire_values(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded mentions; some cut short, some with a count of the wrong type."""
    n = F.substring("key", 2, 20).cast("long")
    cut = F.substring("value", 1, 30)
    mistyped = F.regexp_replace("value", '"likes":[0-9]+', '"likes":"many"')
    return encode(fx.mentions(spark, sf)).select(
        F.when(n % 41 == 0, cut).when(n % 43 == 0, mistyped).otherwise(F.col("value")).alias("value")
    )


def json_decode(spark, sf):
    return decode(wire_values(spark, sf)).select(
        "mention_id", F.col("ts").cast("string").alias("ts"), "brand", "source", "author",
        "platform", "text", "lang", joined("hashtags"), "author_followers",
        F.coalesce("likes", F.lit(-1)).alias("likes"), "shares", "expected",
    ).where(F.col("mention_id").isNotNull())


def json_encode(spark, sf):
    return encode(fx.mentions(spark, sf))


def valid_rows(spark, sf):
    return mn.valid_rows(fx.raw_mentions(spark, sf)).select("mention_id", "author", "text")


def apply_defaults(spark, sf):
    return mn.apply_defaults(fx.mentions(spark, sf)).select(
        "mention_id", "source", "lang", joined("hashtags"), "author_followers", "likes", "shares"
    )


def rejects(spark, sf):
    _, rejected = mn.split_rejects(fx.raw_mentions(spark, sf))
    return rejected.groupBy("reason", "batch_id").agg(F.count("*").alias("rows"))


def dedup_mentions(spark, sf):
    """The first half of the batches is stored; the rest comes with copies of it."""
    accepted, _ = mn.split_rejects(fx.raw_mentions(spark, sf))
    held = materialise(accepted.select("mention_id", "ts", "author", "text", "batch_id"))
    known = held.where(F.col("batch_id") % 2 == 0)
    return mn.new_mentions(held, known).drop("ts")


def batch_stats(spark, sf):
    return stats(spark, sf).drop("processed_at")


def pipeline_state(spark, sf):
    return reports.pipeline_state(stats(spark, sf)).withColumn(
        "last_updated", F.col("last_updated").cast("string")
    )


def union_of_sources(spark, sf):
    base = fx.mentions(spark, sf).drop("source")
    parts = {
        "feed_x": base.where(F.col("platform") == "view"),
        "feed_y": base.where(F.col("platform") != "view"),
    }
    return union_sources(parts).select("mention_id", "source", "platform")


# --------------------------------------------------------------------------
# B. Text
# --------------------------------------------------------------------------


def strip_accents(spark, sf):
    documents = fx.spread(fx.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    folded = tx.accents.strip_accents(F.col("text"))
    return documents.select("doc_id", F.md5(folded.cast("binary")).alias("folded_md5"))


def normalize_text(spark, sf):
    normal = tx.with_normalized(fx.document_texts(spark, sf))
    return normal.select("mention_id", F.md5(F.col("normalized").cast("binary")).alias("normal_md5"))


def normalize_pages(spark, sf):
    pages = fx.spread(fx.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    normal = tx.with_normalized(pages, "html")
    return normal.select("page_id", F.md5(F.col("normalized").cast("binary")).alias("normal_md5"))


def collapse_phrases(spark, sf):
    normal = tx.with_normalized(fx.document_texts(spark, sf))
    collapsed = tx.collapse_phrases(F.col("normalized"))
    return normal.select("mention_id", F.md5(collapsed.cast("binary")).alias("collapsed_md5"))


def tokenize(spark, sf):
    return tx.with_tokens(fx.document_texts(spark, sf)).select(
        "mention_id",
        F.size("tokens").alias("tokens"),
        F.md5(F.array_join("tokens", " ").cast("binary")).alias("tokens_md5"),
    )


def extract_hashtags(spark, sf):
    pages = fx.spread(fx.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", tx.extract_hashtags(F.col("html")).alias("tags")).select(
        "page_id", joined("tags")
    )


def token_lexicon(spark, sf):
    return detail.token_lexicon(fx.document_texts(spark, sf), KEY).withColumn(
        "value", F.coalesce("value", F.lit(0.0))
    )


def token_stats(spark, sf):
    return detail.token_stats(fx.document_texts(spark, sf), KEY)


# --------------------------------------------------------------------------
# C. Scoped sentiment
# --------------------------------------------------------------------------


def clauses(spark, sf):
    return detail.clauses(fx.document_texts(spark, sf), KEY)


def negation_scope(spark, sf):
    found = detail.opinions(fx.turn_mentions(spark, sf), KEY)
    return found.select("mention_id", "pos", "token", "clause", "negated")


def intensity_scope(spark, sf):
    found = detail.opinions(fx.turn_mentions(spark, sf), KEY)
    return rounded(found.select("mention_id", "pos", "token", "clause", "factor"), "factor")


def opinions(spark, sf):
    return rounded(
        detail.opinions(fx.document_texts(spark, sf), KEY), "factor", "weight", "signed_weight"
    )


def clause_breakdown(spark, sf):
    return detail.clause_breakdown(fx.document_texts(spark, sf), KEY)


def raw_score(spark, sf):
    return detail.raw_scores(fx.document_texts(spark, sf), KEY)


def score_class(spark, sf):
    return with_scores(fx.turn_mentions(spark, sf)).select("mention_id", "score", "sentiment")


def confidence(spark, sf):
    return with_scores(fx.turn_mentions(spark, sf)).select("mention_id", "confidence")


def keywords(spark, sf):
    return with_scores(fx.mentions(spark, sf)).select("mention_id", joined("keywords"))


SCORE_COLUMNS = [
    "mention_id", "sentiment", "score", "raw_score", "confidence", "tokens", "opinions", "decisions",
]


def score_mentions(spark, sf):
    return with_scores(fx.mentions(spark, sf)).select(*SCORE_COLUMNS, joined("keywords"))


def score_documents(spark, sf):
    return with_scores(fx.document_texts(spark, sf)).select(*SCORE_COLUMNS, joined("keywords"))


def opinions_ranked(spark, sf):
    return detail.opinions_ranked(fx.mentions(spark, sf), KEY)


def sql_session(spark: SparkSession, sf: str) -> SparkSession:
    """The session with the SQL functions and the texts as views."""
    sql.register(spark)
    fx.mentions(spark, sf).select("mention_id", "text").createOrReplaceTempView("mention_texts")
    fx.document_texts(spark, sf).createOrReplaceTempView("document_texts")
    return spark


def sql_scores(spark, sf):
    return sql_session(spark, sf).sql(
        "SELECT mention_id, mention_sentiment(text) AS sentiment, mention_score(text) AS score "
        "FROM mention_texts"
    )


def sql_tokens(spark, sf):
    return sql_session(spark, sf).sql(
        "SELECT mention_id, size(list) AS tokens, md5(array_join(list, ' ')) AS tokens_md5 "
        "FROM (SELECT mention_id, mention_token_list(text) AS list FROM document_texts)"
    )


def sql_opinions(spark, sf):
    return sql_session(spark, sf).sql(
        "SELECT mention_id, o.* FROM mention_texts, LATERAL mention_opinions(text) o"
    )


def correct_flag(spark, sf):
    return facts(spark, sf).select(
        "mention_id", mn.correct_flag().cast("string").alias("correct")
    )


def mention_facts(spark, sf):
    return facts(spark, sf).drop("batch_id", "processed_at").withColumns(
        {
            "ts": F.col("ts").cast("string"),
            "hashtags": F.array_join("hashtags", ","),
            "keywords": F.array_join("keywords", ","),
        }
    )


# --------------------------------------------------------------------------
# D. Graph
# --------------------------------------------------------------------------


def node_contrib(spark, sf):
    return graph.node_contributions(facts(spark, sf), "mention_id")


def edge_contrib(spark, sf):
    return graph.edge_contributions(facts(spark, sf), "mention_id")


def edge_contrib_join(spark, sf):
    return graph.edge_contributions_joined(materialise(facts(spark, sf)))


def graph_nodes(spark, sf):
    return graph.graph_nodes(facts(spark, sf))


def graph_edges(spark, sf):
    return graph.graph_edges(facts(spark, sf))


def facts_with_null_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Facts scored elsewhere: some have no tags, some no keywords, some neither."""
    n = F.substring("mention_id", 2, 20).cast("long")
    return facts(spark, sf).withColumns(
        {
            "hashtags": F.when(n % 4 != 1, F.col("hashtags")),
            "keywords": F.when(n % 3 != 0, F.col("keywords")),
        }
    )


def graph_nodes_null_lists(spark, sf):
    return graph.graph_nodes(facts_with_null_lists(spark, sf))


def graph_edges_null_lists(spark, sf):
    return graph.graph_edges(facts_with_null_lists(spark, sf))


def graph_elements_null_lists(spark, sf):
    every_node, every_edge = graph.build_graph(facts_with_null_lists(spark, sf))
    ids = [every_node.select(F.col("node_id").alias("element"), "weight")]
    ids.append(every_edge.select(graph.edge_id().alias("element"), "weight"))
    return ids[0].unionByName(ids[1])


def edge_contrib_join_null_lists(spark, sf):
    return graph.edge_contributions_joined(materialise(facts_with_null_lists(spark, sf)))


def graph_sentiment(spark, sf):
    every_node, every_edge = stored_graph(spark, sf)
    named = every_edge.select(graph.edge_id().alias("element"), "weight", "sentiment")
    return every_node.select(F.col("node_id").alias("element"), "weight", "sentiment").unionByName(named)


def graph_top_nodes(spark, sf):
    return graph.top_nodes(nodes(spark, sf))


def graph_kept_edges(spark, sf):
    every_node, every_edge = stored_graph(spark, sf)
    # Written once: it is counted and read for both ends.
    kept = materialise(graph.top_nodes(every_node, 20).select("node_id"))
    return graph.edges_among_kept(every_edge, kept)


def graph_increment(spark, sf):
    """Per-batch ledger; every third batch arrives twice."""
    ledger = materialise(
        graph.aggregate_nodes(graph.node_contributions(facts(spark, sf), "batch_id"), "batch_id")
    )
    again = ledger.where(F.col("batch_id") % 3 == 0)
    applied = ledger.unionByName(again).dropDuplicates(["batch_id", "node_id"])
    return graph.merge_nodes(applied)


def graph_slice_nodes(spark, sf):
    return graph.slice_nodes(nodes(spark, sf))


def graph_slice_edges(spark, sf):
    every_node, every_edge = stored_graph(spark, sf)
    chosen = graph.slice_nodes(every_node).select("node_id")
    return graph.slice_edges(every_edge, chosen)


def graph_label_counts(spark, sf):
    return graph.label_counts(nodes(spark, sf))


def graph_list(spark, sf):
    return graph.list_nodes(nodes(spark, sf)).select("node_id", "label", "name", "weight")


VISIBLE_KINDS = ["MARCA", "PLATAFORMA", "HASHTAG", "PALABRA"]


def graph_visible(spark, sf):
    every_node, _ = stored_graph(spark, sf)
    return graph.visible_nodes(every_node, VISIBLE_KINDS).drop("pos", "neu", "neg")


def graph_neighbourhood(spark, sf):
    every_node, every_edge = stored_graph(spark, sf)
    members, connecting = graph.neighbourhood(every_node, every_edge, f"MARCA:{BRAND}")
    named = connecting.select(graph.edge_id().alias("element"), "weight", "sentiment")
    return members.select(F.col("node_id").alias("element"), "weight", "sentiment").unionByName(named)


def graph_brand_neighbours(spark, sf):
    return graph.brand_neighbours(edges(spark, sf))


def graph_scaled(spark, sf):
    every_node, every_edge = stored_graph(spark, sf)
    shown = materialise(graph.visible_nodes(every_node, VISIBLE_KINDS))
    between = materialise(graph.edges_among(every_edge, shown))
    sized = graph.scaled(shown, graph.NODE_CONSTANT).select(
        F.col("node_id").alias("element"), "weight", "size"
    )
    links = graph.scaled(between, graph.EDGE_CONSTANT)
    return sized.unionByName(links.select(graph.edge_id().alias("element"), "weight", "size"))


def _session(elements: DataFrame) -> DataFrame:
    return elements.select(
        "src", F.coalesce("dst", F.lit("")).alias("dst"), F.coalesce("rel", F.lit("")).alias("rel"),
        F.coalesce("name", F.lit("")).alias("name"), "weight", "pos", "neu", "neg", "sentiment",
    )


def session(spark, sf):
    return _session(session_graph(facts(spark, sf)))


def session_ties(spark, sf):
    """Many messages of the same time: they touch their elements one after another."""
    same = facts(spark, sf).withColumn("ts", F.date_trunc("day", "ts"))
    return _session(session_graph(same, keep=60))


def session_capped(spark, sf):
    return _session(session_graph(facts(spark, sf), keep=60))


def applied_batches(spark, sf):
    return reports.applied_batches(stats(spark, sf))


# --------------------------------------------------------------------------
# E. Reports
# --------------------------------------------------------------------------


def minute_buckets(spark, sf):
    rows = facts(spark, sf)
    now = reports.latest(fx.mentions(spark, sf))
    return reports.minute_buckets(rows, now, DAY).withColumn(
        "bucket", F.col("bucket").cast("string")
    )


def trend(spark, sf):
    now = reports.latest(fx.mentions(spark, sf))
    points = reports.trend(reports.buckets(facts(spark, sf)), now, DAY)
    return points.withColumn("bucket", F.col("bucket").cast("string"))


def kpis(spark, sf):
    return reports.kpis(facts(spark, sf))


def kpi_ratios(spark, sf):
    return reports.kpi_ratios(reports.kpis(facts(spark, sf)))


def accuracy_pct(spark, sf):
    return reports.accuracy_shares(facts(spark, sf))


def confusion(spark, sf):
    return reports.confusion(facts(spark, sf))


def confusion_documents(spark, sf):
    """Labels of documents against their scores."""
    labels = fx.table(spark, sf, "labels").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("mention_id"),
        F.when(F.col("toxic") == 1, "NEGATIVO").when(F.col("quality") == 1, "POSITIVO")
        .otherwise("NEUTRAL").alias("expected"),
    )
    scored = with_scores(fx.document_texts(spark, sf)).select("mention_id", "sentiment")
    return reports.confusion(scored.join(labels, "mention_id", "left"))


def class_accuracy(spark, sf):
    return reports.class_accuracy(facts(spark, sf))


def latest_mentions(spark, sf):
    recent = fx.mentions(spark, sf).orderBy(F.desc("processed_at"), "mention_id").limit(200)
    newest = reports.latest_mentions(mn.mention_facts(recent, ("processed_at",)), 200)
    return newest.withColumns(
        {
            "ts": F.col("ts").cast("string"),
            "keywords": F.array_join("keywords", ","),
            "correct": F.col("correct").cast("string"),
        }
    )


def batch_list(spark, sf):
    return reports.batch_list(stats(spark, sf)).withColumn(
        "processed_at", F.col("processed_at").cast("string")
    )


def batch_totals(spark, sf):
    return reports.batch_totals(stats(spark, sf))


def work_ratio(spark, sf):
    return reports.work_ratio(stats(spark, sf))


def newest_batches(spark, sf):
    return reports.newest_batches(stats(spark, sf)).drop("processed_at")


def health(spark, sf):
    state = reports.health(stats(spark, sf), fx.mentions(spark, sf), BRAND)
    return state.withColumn("last_updated", F.col("last_updated").cast("string"))


def source_platform(spark, sf):
    return reports.source_platform(facts(spark, sf))


def batch_counters(spark, sf):
    return reports.batch_counters(facts(spark, sf)).drop("processed_at")


def batch_accuracy(spark, sf):
    counters = reports.with_batch_accuracy(reports.batch_counters(facts(spark, sf)))
    return counters.select("batch_id", "messages", "correct", "accuracy")


def batch_summary(spark, sf):
    stored = materialise(facts(spark, sf))
    return reports.batch_summary(
        reports.batch_counters(stored),
        graph.aggregate_nodes(graph.node_contributions(stored, "batch_id"), "batch_id"),
        graph.aggregate_edges(graph.edge_contributions(stored, "batch_id"), "batch_id"),
    )


# --------------------------------------------------------------------------
# F, G. Work bound, order
# --------------------------------------------------------------------------


def work_bound(spark, sf):
    return detail.token_stats(fx.mentions(spark, sf), KEY).select("mention_id", "tokens", "bound")


def global_sort(spark, sf):
    rows = facts(spark, sf).select("mention_id", "score")
    return ordering.global_sort(rows, F.col("score"), "mention_id", descending=True)


def merge_sorted(spark, sf):
    rows = fx.mentions(spark, sf).select("mention_id", "brand", "author_followers")
    parts = [rows.where(F.col("brand") == b) for b in fx.BRANDS]
    return ordering.merge_sorted(parts, F.col("author_followers"), "mention_id")


def keyword_topk(spark, sf):
    return ordering.keyword_topk(facts(spark, sf))


QUERIES: dict[str, Query] = {
    "json_decode": json_decode,
    "json_encode": json_encode,
    "valid_rows": valid_rows,
    "apply_defaults": apply_defaults,
    "rejects": rejects,
    "dedup_mentions": dedup_mentions,
    "batch_stats": batch_stats,
    "pipeline_state": pipeline_state,
    "union_sources": union_of_sources,
    "strip_accents": strip_accents,
    "normalize_text": normalize_text,
    "normalize_pages": normalize_pages,
    "collapse_phrases": collapse_phrases,
    "tokenize": tokenize,
    "extract_hashtags": extract_hashtags,
    "token_lexicon": token_lexicon,
    "token_stats": token_stats,
    "clauses": clauses,
    "negation_scope": negation_scope,
    "intensity_scope": intensity_scope,
    "opinions": opinions,
    "clause_breakdown": clause_breakdown,
    "raw_score": raw_score,
    "score_class": score_class,
    "confidence": confidence,
    "keywords": keywords,
    "score_mentions": score_mentions,
    "score_documents": score_documents,
    "opinions_ranked": opinions_ranked,
    "sql_scores": sql_scores,
    "sql_tokens": sql_tokens,
    "sql_opinions": sql_opinions,
    "correct_flag": correct_flag,
    "mention_facts": mention_facts,
    "node_contrib": node_contrib,
    "edge_contrib": edge_contrib,
    "edge_contrib_join": edge_contrib_join,
    "graph_nodes": graph_nodes,
    "graph_edges": graph_edges,
    "graph_sentiment": graph_sentiment,
    "graph_top_nodes": graph_top_nodes,
    "graph_kept_edges": graph_kept_edges,
    "graph_increment": graph_increment,
    "graph_slice_nodes": graph_slice_nodes,
    "graph_slice_edges": graph_slice_edges,
    "graph_label_counts": graph_label_counts,
    "graph_list": graph_list,
    "graph_visible": graph_visible,
    "graph_neighbourhood": graph_neighbourhood,
    "graph_brand_neighbours": graph_brand_neighbours,
    "graph_scaled": graph_scaled,
    "session_graph": session,
    "session_graph_capped": session_capped,
    "session_graph_ties": session_ties,
    "graph_nodes_null_lists": graph_nodes_null_lists,
    "graph_edges_null_lists": graph_edges_null_lists,
    "graph_elements_null_lists": graph_elements_null_lists,
    "edge_contrib_join_null_lists": edge_contrib_join_null_lists,
    "applied_batches": applied_batches,
    "minute_buckets": minute_buckets,
    "trend": trend,
    "kpis": kpis,
    "kpi_ratios": kpi_ratios,
    "accuracy_pct": accuracy_pct,
    "confusion": confusion,
    "confusion_documents": confusion_documents,
    "class_accuracy": class_accuracy,
    "latest_mentions": latest_mentions,
    "batch_list": batch_list,
    "batch_totals": batch_totals,
    "work_ratio": work_ratio,
    "newest_batches": newest_batches,
    "health": health,
    "source_platform": source_platform,
    "batch_counters": batch_counters,
    "batch_accuracy": batch_accuracy,
    "batch_summary": batch_summary,
    "work_bound": work_bound,
    "global_sort": global_sort,
    "merge_sorted": merge_sorted,
    "keyword_topk": keyword_topk,
    **STREAM_QUERIES,
}
