"""Connected components by alternating large-star and small-star steps.

Every step is a join of the links with the smallest neighbour of each node, so a node
with many links is an ordinary skewed join key and no group is ever collected.  The
links are written to the shared folder after each step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import remove, work_folder


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: from the larger node u to the smaller node v."""
    if large:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select(F.col("u").alias("at"), F.least("u", "low").alias("low"))
    near = both.join(least, F.col("u") == F.col("at"))
    if large:
        moved = near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = near.filter(F.col("v") != F.col("low")).select(
            F.col("v").alias("u"), F.col("low").alias("v")
        ).unionAll(least.select(F.col("at").alias("u"), F.col("low").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for all nodes with a link.

    links has columns u and v in any order; links of a node to itself and repeated
    ones change nothing.
    """
    spark = links.sparkSession
    folder = work_folder(spark, "components")
    schema = "u long, v long"
    state = (
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
    before, turn = None, 0
    while True:
        state.write.parquet(f"{folder}/{turn}")
        if turn:
            remove(spark, f"{folder}/{turn - 1}")
        state = spark.read.schema(schema).parquet(f"{folder}/{turn}")
        now = state.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if not now[0] or now == before:
            break
        before, turn = now, turn + 1
        state = _star(_star(state, large=True), large=False)
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
