"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test tables (default sf0.1), BENCH_CPUS the cores
(default all).  Every result is computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from clamor.plans.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINE = [
    "score_mentions", "score_documents", "tokenize", "normalize_text", "clause_breakdown",
    "opinions_ranked", "dedup_mentions", "mention_facts", "kpi_ratios", "trend", "confusion",
    "batch_counters", "latest_mentions", "keyword_topk", "graph_nodes", "graph_edges",
    "graph_top_nodes", "graph_kept_edges", "graph_slice_edges", "graph_increment",
    "session_graph_capped",
]
STREAMS = ["stream_run", "stream_buckets"]


def seconds(spark: SparkSession, name: str, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        begin = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - begin)
    return round(best, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("clamor-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clamor-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE + STREAMS
    timed = {n: seconds(spark, n, 1 if n in STREAMS else 2) for n in names}
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rates = {
        n: round(rows / timed[n])
        for n, rows in (
            ("score_mentions", events), ("score_documents", documents),
            ("tokenize", documents), ("graph_nodes", events), ("stream_run", events),
        )
        if n in timed
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "rows_per_sec": rates,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
