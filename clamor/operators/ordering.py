"""Global order, merge of sorted parts, and per-batch keyword ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def global_sort(df: DataFrame, key: Column, tie: str, descending: bool = False) -> DataFrame:
    """Total order by key; ``tie`` makes equal keys come out the same each time."""
    return df.orderBy(key.desc() if descending else key.asc(), F.asc(tie))


def merge_sorted(parts: list[DataFrame], key: Column, tie: str) -> DataFrame:
    """One ordered table from several parts."""
    return global_sort(reduce(DataFrame.unionByName, parts), key, tie)


def keyword_topk(facts: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent keywords of each batch.

    Keywords are counted before they are ranked, and the rank limit lets Spark
    drop the rest of a batch in every task before the shuffle.
    """
    counted = (
        facts.select("batch_id", F.explode_outer("keywords").alias("keyword"))
        .where(F.col("keyword").isNotNull())
        .groupBy("batch_id", "keyword")
        .agg(F.count("*").alias("mentions"))
    )
    order = Window.partitionBy("batch_id").orderBy(F.desc("mentions"), "keyword")
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
