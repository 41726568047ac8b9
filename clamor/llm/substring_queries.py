"""Repeated passages of all documents.  SQL cannot express the rolling hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from clamor.llm.common import table
from clamor.llm.substring_dedup import with_repeats_removed


def op7_substring_dedup(spark, sf_dir):
    """A row for each document: what was taken out, from which documents it is known,
    and the digest of the text that is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = F.coalesce("removed.text", "text", F.lit(""))
    return with_repeats_removed(docs).select(
        "doc_id",
        F.coalesce("removed.words", F.lit(0).cast("long")).alias("removed_words"),
        F.coalesce("removed.spans", F.lit("")).alias("removed_spans"),
        F.coalesce("removed.sources", F.array().cast("array<long>")).alias("source_ids"),
        F.length(left).cast("long").alias("kept_chars"),
        F.sha2(left, 256).alias("kept_sha256"),
    )


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
ORACLES = {}
