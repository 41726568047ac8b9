"""Rows from message to stored fact: filter, defaults, rejects, dedupe, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.functions.scoring import with_scores
from clamor.schema import CLASSES, DEFAULT_LANG, DEFAULT_SOURCE, FACT_COLUMNS
from clamor.session import materialise

SPECIAL = 500_000  # ids that are sent to all tasks at most
REQUIRED = ["ts", "brand", "platform", "author"]


def valid_rows(messages: DataFrame) -> DataFrame:
    """Rows that can be scored: both id and text present."""
    return messages.where(F.col("mention_id").isNotNull() & F.col("text").isNotNull())


def apply_defaults(messages: DataFrame) -> DataFrame:
    """Null or empty texts, null counts and null tag lists get their default."""

    def text_or(name: str, default: str) -> Column:
        return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default))

    def count_of(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("int")

    return messages.withColumns(
        {
            "source": text_or("source", DEFAULT_SOURCE),
            "lang": text_or("lang", DEFAULT_LANG),
            "hashtags": F.coalesce("hashtags", F.array().cast("array<string>")),
            "author_followers": count_of("author_followers"),
            "likes": count_of("likes"),
            "shares": count_of("shares"),
        }
    )


def reject_reason(spark_columns: list[str]) -> Column:
    """First constraint a row breaks, null if it breaks none."""
    reason = F.when(F.col("mention_id").isNull(), "mention_id missing").when(
        F.col("text").isNull(), "text missing"
    )
    for name in REQUIRED:
        if name in spark_columns:
            reason = reason.when(F.col(name).isNull(), f"{name} missing")
    return reason.when(~F.col("expected").isin(CLASSES), "expected not a class")


def split_rejects(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with a ``reason``)."""
    marked = messages.withColumn("reason", reject_reason(messages.columns))
    return (
        marked.where(F.col("reason").isNull()).drop("reason"),
        marked.where(F.col("reason").isNotNull()),
    )


def dedupe(messages: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per ``mention_id``, the first by ``order``, then by content."""
    return new_mentions(messages, None, order)


def new_mentions(
    messages: DataFrame, known: DataFrame | None, order: list[str] | None = None
) -> DataFrame:
    """First row of each ``mention_id`` that is not among the ``known`` ids.

    One pass over the ids alone, which combines in every task before the shuffle, finds
    those that occur more than once or are known, and writes them.  Up to SPECIAL of them
    are sent to the rows, so that no row is shuffled but the first of each repeated id in
    each task; beyond that Spark shuffles the rows by id.  ``messages`` is read three
    times, once for ids only, and should be held or stored.
    """
    rest = [c for c in messages.columns if c != "mention_id"]
    first = [c for c in (order or ["ts"]) if c in rest]
    ranked = F.struct(*first, *[c for c in rest if c not in first])
    ids = messages.groupBy(F.col("mention_id").alias("_id")).agg(F.count("*").alias("_copies"))
    if known is None:
        ids = ids.withColumn("_known", F.lit(False))
    else:
        # The history meets the ids of the messages only, and is not shuffled if these are few.
        met = known.select("mention_id").join(
            messages.select("mention_id"), "mention_id", "left_semi"
        )
        seen = met.distinct().select(F.col("mention_id").alias("_seen"), F.lit(True).alias("_known"))
        ids = ids.join(seen, F.col("_id") == F.col("_seen"), "left").select(
            "_id", "_copies", F.coalesce("_known", F.lit(False)).alias("_known")
        )
    special = materialise(ids.where((F.col("_copies") > 1) | F.col("_known")))
    if special.count() <= SPECIAL:
        special = F.broadcast(special)
    same = F.col("mention_id").eqNullSafe(F.col("_id"))
    single = messages.join(special, same, "left_anti")
    copies = messages.join(special.where(~F.col("_known")), same, "left_semi")
    kept = copies.groupBy("mention_id").agg(F.min(ranked).alias("_kept"))
    return single.unionByName(
        kept.select(*["mention_id" if c == "mention_id" else F.col("_kept")[c].alias(c)
                      for c in messages.columns])
    )


def without_known(messages: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose id is not among ``known`` ids.

    ``known`` is the whole history: only those of its ids that occur in ``messages`` are
    looked for.  Where Spark knows that the ids of ``messages`` are small (they are held, or
    a table) it sends them to the scan, and the history is not shuffled.
    """
    ids = known.select("mention_id").join(messages.select("mention_id"), "mention_id", "left_semi")
    return messages.join(ids.distinct(), "mention_id", "left_anti")


def correct_flag(expected: str = "expected", sentiment: str = "sentiment") -> Column:
    """Label equals class; null where there is no label."""
    return F.col(expected) == F.col(sentiment)


def mention_facts(messages: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Scored, defaulted rows with the columns that are stored."""
    return with_scores(apply_defaults(messages)).select(*FACT_COLUMNS, *extra)
