"""The training-data pipeline: five stages from documents to packed sequences.

Each stage is written to the shared folder as Parquet and read again by the next one,
so that a lost executor costs no more than its own stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clamor.llm.common import prepared, table, work_folder
from clamor.llm.exact_dedup import drop_exact_copies
from clamor.llm.packing import pack
from clamor.llm.simhash import drop_near_copies
from clamor.llm.substring_dedup import drop_repeats
from clamor.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepared(spark)
    return drop_near_copies(docs, shingle=3, distance=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document holds."""
    prepared(spark)
    return drop_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of up to 2,048 tokens."""
    prepared(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# SQL can express neither the classifier nor the fingerprints, the chunks and the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
