"""Reports over scored facts and over batch records.

``as_of`` stands for the current time, so that a report can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clamor.functions.scoring import NEGATIVE, NEUTRAL, POSITIVE
from clamor.functions.text import work_bound
from clamor.operators.mentions import correct_flag
from clamor.schema import CLASSES, UNLABELLED

SKETCH_BITS = 12  # a sketch has 2^12 registers: standard error 1.6 %


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, digits)).otherwise(F.lit(0.0))


def latest(facts: DataFrame, column: str = "ts") -> Column:
    """Newest time in the table as a scalar subquery."""
    return facts.agg(F.max(column)).scalar()


# --------------------------------------------------------------------------
# Time
# --------------------------------------------------------------------------


def window_start(as_of: Column, minutes: int) -> Column:
    """Start of the last minutes, a whole minute."""
    return F.date_trunc("minute", as_of) - F.make_interval(mins=F.lit(minutes))


def buckets(facts: DataFrame, *extra: str) -> DataFrame:
    """Mentions per minute and class."""
    minute = F.date_trunc("minute", "ts").alias("bucket")
    return facts.groupBy(*extra, minute, "sentiment").agg(F.count("*").alias("mentions"))


def minute_buckets(facts: DataFrame, as_of: Column, window_minutes: int = 20) -> DataFrame:
    """Buckets of the last minutes.

    The window starts at a whole minute, so a recomputed bucket is never
    smaller than the one it replaces.
    """
    return buckets(facts.where(F.col("ts") >= window_start(as_of, window_minutes)))


def trend(bucket_rows: DataFrame, as_of: Column, minutes: int = 30) -> DataFrame:
    """One row per minute with a column per class and their total."""
    if not 1 <= minutes <= 1440:
        raise ValueError("minutes must be between 1 and 1440")
    start = window_start(as_of, minutes)

    def of_class(label: str) -> Column:
        return F.sum(F.when(F.col("sentiment") == label, F.col("mentions")).otherwise(0))

    return (
        bucket_rows.where(F.col("bucket") >= start)
        .groupBy("bucket")
        .agg(*[of_class(c).alias(c) for c in CLASSES])
        .withColumn("total", sum((F.col(c) for c in CLASSES), F.lit(0)).cast("long"))
        .orderBy("bucket")
    )


# --------------------------------------------------------------------------
# Whole table
# --------------------------------------------------------------------------


def kpis(facts: DataFrame) -> DataFrame:
    """Totals, averages and distinct counts in one row.

    Facts are first added up per author and platform; the distinct counts then
    run over that much smaller table instead of over every fact.
    """
    per_pair = facts.groupBy("author", "platform").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("sentiment") == c).alias(c) for c in CLASSES],
        F.count("expected").alias("labelled"),
        F.count_if(correct_flag()).alias("correct"),
        F.sum("score").alias("score"),
        F.sum("confidence").alias("confidence"),
        F.sum("decisions").alias("decisions"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    def mean(name: str, digits: int) -> Column:
        return F.round(F.try_divide(F.sum(name), F.sum("total")), digits)

    return per_pair.agg(
        total("total").alias("total"),
        total(POSITIVE).alias("positive"),
        total(NEUTRAL).alias("neutral"),
        total(NEGATIVE).alias("negative"),
        total("labelled").alias("labelled"),
        total("correct").alias("correct"),
        mean("score", 4).alias("avg_score"),
        mean("confidence", 4).alias("avg_confidence"),
        mean("decisions", 1).alias("avg_decisions"),
        F.countDistinct("author").alias("authors"),
        F.countDistinct("platform").alias("platforms"),
    )


def kpis_of_batches(stats: DataFrame) -> DataFrame:
    """``kpis`` from the records of batches, without a look at the facts.

    Totals and averages are those of the facts.  ``authors`` and ``platforms`` are
    estimates of the merged sketches (standard error 1.6 %; few values are counted exactly).
    """

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    def mean(name: str, digits: int) -> Column:
        return F.round(F.try_divide(F.sum(name), F.sum("messages")), digits)

    def distinct(name: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).cast("long")

    return stats.agg(
        total("messages").alias("total"),
        total("positive").alias("positive"),
        total("neutral").alias("neutral"),
        total("negative").alias("negative"),
        total("labelled").alias("labelled"),
        total("correct").alias("correct"),
        mean("score_sum", 4).alias("avg_score"),
        mean("confidence_sum", 4).alias("avg_confidence"),
        mean("decisions", 1).alias("avg_decisions"),
        distinct("authors").alias("authors"),
        distinct("platforms").alias("platforms"),
    )


def kpi_ratios(kpi_row: DataFrame) -> DataFrame:
    """Accuracy among labelled rows and class shares, 0 where there is nothing."""
    total = F.col("total")
    return kpi_row.withColumns(
        {
            "accuracy": percent(F.col("correct"), F.col("labelled"), 2),
            "pct_positive": percent(F.col("positive"), total, 1),
            "pct_neutral": percent(F.col("neutral"), total, 1),
            "pct_negative": percent(F.col("negative"), total, 1),
        }
    )


def accuracy_shares(facts: DataFrame) -> DataFrame:
    """Labelled rows by label and class, with the share of their grand total.

    The window sees one row per label and class, nine at most.
    """
    counted = (
        facts.where(F.col("expected").isNotNull())
        .groupBy("expected", F.col("sentiment").alias("predicted"))
        .agg(F.count("*").alias("mentions"))
    )
    whole = F.sum("mentions").over(Window.partitionBy())
    return counted.withColumn("pct", F.round(F.lit(100.0) * F.col("mentions") / whole, 2))


def confusion(facts: DataFrame) -> DataFrame:
    """All rows by label and class; unlabelled rows under a name of their own."""
    return (
        facts.groupBy(
            F.coalesce("expected", F.lit(UNLABELLED)).alias("expected"),
            F.col("sentiment").alias("predicted"),
        )
        .agg(F.count("*").alias("total"))
        .orderBy("expected", "predicted")
    )


def class_accuracy(facts: DataFrame) -> DataFrame:
    correct = F.count_if(correct_flag())
    return (
        facts.where(F.col("expected").isNotNull())
        .groupBy("expected")
        .agg(F.count("*").alias("total"), correct.alias("correct"))
        .withColumn("accuracy", percent(F.col("correct"), F.col("total"), 2))
        .orderBy("expected")
    )


def latest_mentions(facts: DataFrame, limit: int = 30) -> DataFrame:
    """Newest mentions by processing time."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be between 1 and 200")
    return (
        facts.orderBy(F.desc("processed_at"), F.asc("mention_id"))
        .limit(limit)
        .select(
            "mention_id", "ts", "platform", "author", "text", "sentiment", "score", "confidence",
            "keywords", "expected", correct_flag().alias("correct"), "decisions", "opinions",
            "tokens",
        )
    )


def source_platform(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("source", "platform")
        .agg(F.count("*").alias("mentions"))
        .orderBy("source", "platform")
    )


# --------------------------------------------------------------------------
# Batches
# --------------------------------------------------------------------------


def batch_counters(facts: DataFrame, keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Work and result counters per batch."""
    return facts.groupBy(*keys).agg(*_counters())


def batch_record(facts: DataFrame, keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """``batch_counters`` with what lets reports do without the facts of a batch: sums and
    mergeable sketches for the KPIs, and the first and last time of its mentions."""
    return facts.groupBy(*keys).agg(
        *_counters(),
        F.count("expected").alias("labelled"),
        F.sum("score").alias("score_sum"),
        F.sum("confidence").alias("confidence_sum"),
        F.hll_sketch_agg("author", SKETCH_BITS).alias("authors"),
        F.hll_sketch_agg("platform", SKETCH_BITS).alias("platforms"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def _counters() -> list[Column]:
    return [
        F.max("processed_at").alias("processed_at"),
        F.count("*").alias("messages"),
        F.sum("tokens").alias("total_tokens"),
        F.sum("decisions").alias("decisions"),
        F.sum("opinions").alias("opinions"),
        F.sum(work_bound(F.col("tokens"))).alias("bound"),
        F.max("tokens").cast("long").alias("max_tokens"),
        F.count_if(correct_flag()).alias("correct"),
        F.count_if(F.col("sentiment") == POSITIVE).alias("positive"),
        F.count_if(F.col("sentiment") == NEUTRAL).alias("neutral"),
        F.count_if(F.col("sentiment") == NEGATIVE).alias("negative"),
    ]


def with_batch_accuracy(counters: DataFrame) -> DataFrame:
    """Correct rows among all messages of the batch, labelled or not."""
    return counters.withColumn("accuracy", percent(F.col("correct"), F.col("messages"), 2))


def batch_list(stats: DataFrame, limit: int = 40) -> DataFrame:
    """Newest batches first; batch numbers start again with each run."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    return stats.orderBy(F.desc("processed_at"), F.desc("batch_id")).limit(limit).select(
        "batch_id", "processed_at", "messages", "total_tokens", "decisions", "opinions", "bound",
        "max_tokens",
    )


def batch_totals(stats: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name)

    return stats.agg(
        *[total(c) for c in ("messages", "total_tokens", "decisions", "opinions", "bound")],
        F.coalesce(F.max("max_tokens"), F.lit(0)).cast("long").alias("max_tokens"),
    )


def work_ratio(stats: DataFrame) -> DataFrame:
    """Decisions per unit of the bound over all batches, null without a bound."""
    return stats.agg(
        F.round(F.try_divide(F.sum("decisions"), F.nullif(F.sum("bound"), F.lit(0))), 2).alias(
            "work_ratio"
        )
    )


def newest_batches(stats: DataFrame, limit: int = 8) -> DataFrame:
    return batch_list(stats, limit)


def pipeline_state(stats: DataFrame) -> DataFrame:
    """Brand and number of the last batch, and when it was processed.

    Batch numbers start again with each run, so time decides.
    """
    last = F.max(F.struct("processed_at", "batch_id", "brand"))
    return stats.agg(last.alias("last")).select(
        F.col("last.brand").alias("brand"),
        F.col("last.batch_id").alias("last_batch"),
        F.col("last.processed_at").alias("last_updated"),
    )


def health(stats: DataFrame, facts: DataFrame | None, default_brand: str) -> DataFrame:
    """One status row; -1 and the default brand before the first batch.

    Without ``facts`` the mentions are those that the records count.
    """
    state = pipeline_state(stats)
    if facts is None:
        counted = stats.agg(F.coalesce(F.sum("messages"), F.lit(0)).alias("mentions"))
    else:
        counted = facts.agg(F.count("*").alias("mentions"))
    return state.select(
        F.lit("ok").alias("status"),
        F.coalesce("brand", F.lit(default_brand)).alias("brand"),
        F.coalesce("last_batch", F.lit(-1)).cast("long").alias("last_batch"),
        "last_updated",
        counted.scalar().alias("mentions"),
    )


def applied_batches(stats: DataFrame, keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    return stats.agg(F.countDistinct(*keys).alias("batches"))


def batch_summary(stats: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The log line of each batch: counters, accuracy and graph sizes.

    ``nodes`` and ``edges`` hold one row per batch and element.
    """
    node_counts = nodes.groupBy("batch_id").agg(F.count("*").alias("nodes"))
    edge_counts = edges.groupBy("batch_id").agg(F.count("*").alias("edges"))
    return (
        with_batch_accuracy(stats)
        .join(node_counts, "batch_id", "left")
        .join(edge_counts, "batch_id", "left")
        .na.fill(0, ["nodes", "edges"])
        .select(
            "batch_id", "messages", "accuracy", "decisions", "bound", "opinions", "max_tokens",
            "positive", "neutral", "negative", "nodes", "edges",
        )
    )
