"""Stored tables of the job: facts, rejects, bucket and graph ledgers, records.

Every table is parquet under ``root/<table>/run_id=R/batch_id=N``.  A batch
writes each of its partitions whole, so writing it again replaces it and never
adds to it.  The record in ``batch_stats`` is written last and marks the batch
as complete.  ``run_id`` is the id of the streaming query, which lives in its
checkpoint: when a checkpoint is lost, batch numbers start again at 0 under a
new run and cannot be mistaken for old ones.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clamor.operators import graph, reports

PARTITION = "run_id string, batch_id bigint"
TABLES = {
    "mentions": (
        "mention_id string, ts timestamp, brand string, source string, platform string, "
        "author string, author_followers int, text string, lang string, "
        "hashtags array<string>, keywords array<string>, sentiment string, score double, "
        "confidence double, tokens int, opinions int, decisions int, expected string, "
        "likes int, shares int, processed_at timestamp"
    ),
    "ids": "mention_id string",
    "rejects": "mention_id string, ts timestamp, reason string, message string",
    "buckets": "bucket timestamp, sentiment string, mentions bigint",
    "graph": (
        "src string, label string, name string, dst string, rel string, weight bigint, "
        "pos bigint, neu bigint, neg bigint, score_sum double"
    ),
    "batch_stats": (
        "brand string, processed_at timestamp, messages bigint, total_tokens bigint, "
        "decisions bigint, opinions bigint, bound bigint, max_tokens bigint, correct bigint, "
        "positive bigint, neutral bigint, negative bigint, labelled bigint, score_sum double, "
        "confidence_sum double, authors binary, platforms binary, first_ts timestamp, "
        "last_ts timestamp"
    ),
}
# Partitions that ``compact`` has made, with what their records would tell of times.
FOLDED = f"{PARTITION}, last_ts timestamp, processed_at timestamp"
SEED_RUN = "history"
BATCHES_SENT = 500_000  # keys of batches that are sent to all tasks at most


class MentionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, table: str, run_id: str | None = None, batch_id: int | None = None) -> str:
        parts = [self.root, table]
        if run_id is not None:
            parts.append(f"run_id={run_id}")
        if batch_id is not None:
            parts.append(f"batch_id={batch_id}")
        return "/".join(parts)

    def exists(self, path: str) -> bool:
        """Whether any file or folder matches the path, which may be a glob."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        found = target.getFileSystem(conf).globStatus(target)
        return found is not None and len(found) > 0

    def read(self, table: str) -> DataFrame:
        """All rows of a table with their run and batch; empty before the first."""
        schema = T.StructType.fromDDL(f"{TABLES[table]}, {PARTITION}")
        if not self.exists(self.path(table)):
            # Without rows from Python, so that Spark knows it to be empty and plans no join.
            nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
            return self.spark.range(1).select(*nulls).where(F.lit(False))
        return self.spark.read.schema(schema).parquet(self.path(table))

    def read_batch(self, table: str, run_id: str, batch_id: int) -> DataFrame:
        path = self.path(table, run_id, batch_id)
        return self.spark.read.schema(TABLES[table]).parquet(path)

    def write_batch(self, table: str, rows: DataFrame, run_id: str, batch_id: int) -> None:
        names = T.StructType.fromDDL(TABLES[table]).names
        rows.select(*names).write.mode("overwrite").parquet(self.path(table, run_id, batch_id))

    def is_complete(self, run_id: str, batch_id: int) -> bool:
        """True once the record of a batch, its last table, is committed."""
        return self.exists(f"{self.path('batch_stats', run_id, batch_id)}/part-*")

    def known_ids(self, run_id: str, batch_id: int, ledgers_whole: bool = False) -> DataFrame:
        """Ids of all stored mentions but those of this batch, which must not see itself
        when it is repeated.

        They come from the ledger of ids; no fact file is opened.  Facts whose ids are not
        in it, left by a run that ended in between, are looked for unless the caller knows
        that ``rebuild_ledgers`` has been here.
        """
        own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
        ids = self.read("ids").where(~own).select("mention_id")
        if ledgers_whole:
            return ids
        for run in self.lacking("ids"):
            ids = ids.unionByName(self.rows_of("mentions", *run).where(~own).select("mention_id"))
        return ids

    def rows_of(self, table: str, run_id: str, numbers: list[int]) -> DataFrame:
        """Rows of some batches of a run, read from their partitions alone."""
        own = (F.col("run_id") == run_id) & F.col("batch_id").isin(numbers)
        return self.read(table).where(own)

    def lacking(self, table: str, skipped: str | None = None) -> list[tuple[str, list[int]]]:
        """(run, batches) of stored facts that have no rows in a ledger.

        ``skipped`` names a run whose unfinished batches are left out.
        """
        stored = self.batches("mentions")
        if self.exists(self.path("folded")):
            folded = self.spark.read.schema(PARTITION).parquet(self.path("folded"))
            stored -= {(row["run_id"], row["batch_id"]) for row in folded.collect()}
        if skipped is not None:
            stored -= {b for b in stored if b[0] == skipped} - self.batches("batch_stats")
        missing = stored - self.batches(table)
        return [
            (run_id, sorted(batch for run, batch in missing if run == run_id))
            for run_id in sorted({run for run, _ in missing})
        ]

    def load_history(self, facts: DataFrame, batch_id: int | None = None) -> int:
        """Store facts that were scored elsewhere as a batch of their own.

        Each load has a number above all earlier ones, by default the next; another is
        refused, as facts that others were computed from are never replaced.
        ``rebuild_ledgers`` adds what follows from them.
        """
        taken = {batch for run, batch in self.batches("mentions") if run == SEED_RUN}
        number = max(taken, default=-1) + 1 if batch_id is None else batch_id
        if number <= max(taken, default=-1):
            raise ValueError(f"history batch {number} is stored already")
        self.write_batch("mentions", facts, SEED_RUN, number)
        return number

    # Derived tables -------------------------------------------------------

    def batches(self, table: str) -> set[tuple[str, int]]:
        """(run, batch) of every partition that was written to its end, from names alone."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/run_id=*/batch_id=*/part-*")
        found = pattern.getFileSystem(conf).globStatus(pattern) or []
        folders = {f.getPath().getParent() for f in found}
        pairs = [(f.getParent().getName(), f.getName()) for f in folders]
        return {(run.split("=", 1)[1], int(batch.split("=", 1)[1])) for run, batch in pairs}

    def rebuild_ledgers(self, brand: str = "", running: str | None = None) -> None:
        """Write ids, buckets, graph and batch record for stored facts that lack them.

        Such facts are history, or were left by a run that ended between its outputs and
        whose checkpoint is lost.  ``running`` names the run that goes on from its
        checkpoint: it repeats its last batch itself.  Only the partitions concerned are
        read, each replaces its own partition only, and the record comes last, so this
        is safe to repeat.  A run is worked on at a time, so the batch alone tells groups
        apart.
        """
        keys = ("run_id", "batch_id")

        def stats(facts: DataFrame) -> DataFrame:
            counted = reports.with_batch_accuracy(reports.batch_record(facts, ("batch_id",)))
            return counted.na.fill(0).withColumn("brand", F.lit(brand))

        makers = {
            "ids": lambda facts: facts.select("mention_id", "batch_id"),
            "buckets": lambda facts: reports.buckets(facts, "batch_id"),
            "graph": lambda facts: graph.graph_elements(facts, "batch_id"),
            "batch_stats": stats,
        }
        for table, make in makers.items():
            names = [*T.StructType.fromDDL(TABLES[table]).names, *keys]
            for run_id, numbers in self.lacking(table, running):
                made = make(self.rows_of("mentions", run_id, numbers))
                rows = made.withColumn("run_id", F.lit(run_id)).select(*names)
                rows.write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy(*keys).parquet(self.path(table))

    def complete(self) -> DataFrame:
        """(run_id, batch_id) of the batches that have their record."""
        done = self.read("batch_stats").select("run_id", "batch_id").distinct()
        if self.exists(self.path("folded")):
            done = done.unionAll(self.spark.read.schema(PARTITION).parquet(self.path("folded")))
        return done

    def read_complete(self, table: str) -> DataFrame:
        """Rows of the batches that have their record: all tables agree on these."""
        return self.read(table).join(self.complete(), ["run_id", "batch_id"], "left_semi")

    def extents(self) -> DataFrame:
        """(run_id, batch_id, last_ts, processed_at) of complete batches that have rows."""
        stats = self.read("batch_stats").where(F.col("messages") > 0)
        found = stats.select("run_id", "batch_id", "last_ts", "processed_at")
        if self.exists(self.path("folded")):
            found = found.unionByName(self.spark.read.schema(FOLDED).parquet(self.path("folded")))
        return found

    def read_since(self, table: str, column: str, start: Column) -> DataFrame:
        """Rows of the complete batches that go on to ``start`` or beyond by a column of
        ``extents``, of which some may be earlier.

        The keys of these batches prune the partitions of the table, so the files of older
        batches are not opened.  A batch that tells no time is among them.
        """
        # One comparison, as Spark prunes by keys only behind a filter it takes for selective.
        recent = F.coalesce(F.col(column), start) >= start
        keys = self.extents().where(recent).select("run_id", "batch_id")
        if keys.limit(BATCHES_SENT + 1).count() <= BATCHES_SENT:
            keys = F.broadcast(keys)
        return self.read(table).join(keys, ["run_id", "batch_id"], "left_semi")

    def newest_mentions(self, count: int) -> DataFrame:
        """Rows among which the ``count`` last processed mentions are.

        Each of the ``count`` last batches brought a mention, so none from a batch before
        them can be among the last.
        """
        last = self.extents().orderBy(F.desc("processed_at")).limit(count + 1)
        return self.read_since(
            "mentions", "processed_at", last.agg(F.min("processed_at")).scalar()
        )

    # Graph: a merged base and the ledgers after it ---------------------------

    def graph_base(self) -> tuple[DataFrame | None, dict[str, int]]:
        """(merged elements, last batch that they hold of each run) of the newest base."""
        if not self.exists(self.path("graph_base_state")):
            return None, {}
        state = self.spark.read.parquet(self.path("graph_base_state"))
        newest = state.where(F.col("version") == state.agg(F.max("version")).scalar()).collect()
        schema = T.StructType.fromDDL(TABLES["graph"])
        elements = self.spark.read.schema(schema).parquet(
            f"{self.path('graph_base')}/version={newest[0]['version']}"
        )
        return elements, {r["run_id"]: r["last_batch"] for r in newest}

    def graph_tail(self, held: dict[str, int]) -> DataFrame:
        """Ledger rows of complete batches that a base does not hold.

        The condition is on partition columns alone, one term for each run, so the files
        of the batches in the base are not opened.
        """
        new = reduce(
            lambda c, run: c & ~((F.col("run_id") == run) & (F.col("batch_id") <= held[run])),
            held, F.lit(True),
        )
        return self.read_complete("graph").where(new)

    def graph_elements(self) -> DataFrame:
        """Nodes and edges added up over all complete batches, from base and tail."""
        base, held = self.graph_base()
        tail = self.graph_tail(held).drop("run_id", "batch_id")
        return graph.merge_elements(tail if base is None else base.unionByName(tail))

    def fold_graph(self) -> bool:
        """Write a new base that holds all batches so far; False if there is nothing new.

        Of each run the base takes the batches before its first unfinished one, so that it
        can be told by one number.  The state comes last and names the version; a reader
        sees the old base until then, and old versions are left for readers that run.
        """
        found = self.batches("graph")
        done = {(r["run_id"], r["batch_id"]) for r in self.complete().collect()}
        _, held = self.graph_base()
        last = dict(held)
        for run in {run for run, _ in found}:
            open_batches = [b for r, b in found - done if r == run]
            ends = min(open_batches, default=float("inf"))
            numbers = [b for r, b in found & done if r == run and b < ends]
            if numbers:
                last[run] = max(*numbers, last.get(run, -1))
        if last == held:
            return False
        taken = reduce(
            lambda c, run: c | ((F.col("run_id") == run) & (F.col("batch_id") <= last[run])),
            last, F.lit(False),
        )
        base, _ = self.graph_base()
        fresh = self.graph_tail(held).where(taken).drop("run_id", "batch_id")
        merged = graph.merge_elements(fresh if base is None else base.unionByName(fresh))
        version = uuid.uuid1().time  # grows with time
        merged.write.parquet(f"{self.path('graph_base')}/version={version}")
        rows = [(version, run, batch) for run, batch in last.items()]
        self.spark.createDataFrame(rows, "version long, run_id string, last_batch long").coalesce(
            1
        ).write.mode("append").parquet(self.path("graph_base_state"))
        return True

    def graph(self) -> tuple[DataFrame, DataFrame]:
        """(nodes, edges) added up over all batches."""
        return graph.split_elements(graph.with_sentiment(self.graph_elements()))

    def bucket_rows(self, start: Column | None = None) -> DataFrame:
        """Mentions per minute and class; with ``start``, those from then on are complete
        and the files of batches that end before it stay closed."""
        if start is None:
            rows = self.read_complete("buckets")
        else:
            rows = self.read_since("buckets", "last_ts", start)
        return (
            rows.groupBy("bucket", "sentiment")
            .agg(F.sum("mentions").alias("mentions"))
        )

    def write_graph_snapshot(self, per_label: int) -> tuple[DataFrame, DataFrame]:
        """Replace the snapshot of the heaviest nodes and the edges among them."""
        nodes, edges = self.graph()
        target = self.path("snapshot_nodes")
        graph.top_nodes(nodes, per_label).write.mode("overwrite").parquet(target)
        kept = self.spark.read.parquet(target)
        graph.edges_among_kept(edges, kept).write.mode("overwrite").parquet(
            self.path("snapshot_edges")
        )
        return kept, self.spark.read.parquet(self.path("snapshot_edges"))

    def compact(self, target: "MentionStore", run_id: str) -> None:
        """Copy the store with all batches folded into one partition per table.

        The copy is a store of its own, so a failed run leaves this one as it
        was.  Batch records stay one row each: they tell which batches are done.  The
        folded partition is named in a table of its own, as it has no record.  In every
        table the complete batches are folded and the others are copied as they are, so
        that all tables go on to agree and a rebuild still finds what lacks a record.
        """
        keys = ["run_id", "batch_id"]
        done = self.complete()
        for table in ("mentions", "ids", "rejects"):
            target.write_batch(table, self.read_complete(table), run_id, 0)
        target.write_batch("buckets", self.bucket_rows(), run_id, 0)
        target.write_batch("graph", self.graph_elements(), run_id, 0)
        for table in ("mentions", "ids", "rejects", "buckets", "graph"):
            rest = self.read(table).join(done, keys, "left_anti")
            rest.write.mode("append").partitionBy(*keys).parquet(target.path(table))
        self.read("batch_stats").write.mode("overwrite").partitionBy(
            "run_id", "batch_id"
        ).parquet(target.path("batch_stats"))
        folded = self.extents().agg(
            F.lit(run_id).alias("run_id"), F.lit(0).cast("long").alias("batch_id"),
            F.max("last_ts").alias("last_ts"), F.max("processed_at").alias("processed_at"),
        )
        folded.write.mode("overwrite").parquet(target.path("folded"))


def write_jdbc(rows: DataFrame, url: str, table: str, rows_per_insert: int = 500) -> None:
    """Append rows to a database table; needs its driver on the class path."""
    rows.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "batchsize", rows_per_insert
    ).mode("append").save()


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, parts: int
) -> DataFrame:
    """Read a database table in parallel ranges of a numeric or time column."""
    options = {
        "url": url, "dbtable": table, "partitionColumn": column,
        "lowerBound": lower, "upperBound": upper, "numPartitions": str(parts),
    }
    return spark.read.format("jdbc").options(**options).load()
