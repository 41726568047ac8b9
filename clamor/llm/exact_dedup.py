"""Exact dedup with a heavy-hitter split.

Texts are equal when they are identical after deleting white space.  A
Misra-Gries sketch over 64-bit keys of the digests names the digests that may
hold a large share of the rows; exact counts verify them.  The winners of the
verified groups are broadcast, and the other rows of those groups are settled
where they lie, without moving.  All remaining digests are shuffled as usual.

Of equal texts the row with the most code points in its original text stays,
then the one with the smallest doc_id (null last).  A null text counts as empty.
Rows that repeat a doc_id are rows of their own: each counts in its group and
exactly one row of a group stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clamor.llm.common import fresh, materialise, text_or_empty

# The characters deleted before texts are compared: [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\f\r"

# A digest is heavy with at least one HEAVY-th of all rows, so at most HEAVY rows
# are broadcast.  The sketch errs by at most 3.5 / COUNTERS of the rows; hence fewer
# than CANDIDATES digests can look heavy and every heavy one is among them.
HEAVY = 1024
COUNTERS = 8192
CANDIDATES = 2048


def normalised(text: Column) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE_SPACE, text)


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def heavy_winners(
    keys: DataFrame, digest: str, size: str, doc_id: str, row: str | None = None
) -> DataFrame:
    """digest, rows, top_size, top_id of every digest with its share of all rows; with a
    column that tells rows apart also top_row, the least of those that tie.

    At most HEAVY rows; the counts are exact.
    """
    sketch = keys.agg(
        F.count("*").alias("rows"),
        F.expr(f"approx_top_k(xxhash64(`{digest}`), {CANDIDATES}, {COUNTERS})").alias("top"),
    )
    found = sketch.select("rows", F.col("top.item").alias("items")).first()
    least = max(2, -(-found["rows"] // HEAVY))
    items = keys.sparkSession.createDataFrame([(i,) for i in found["items"] or []], "item long")
    first = F.struct(
        (-F.col(size)).alias("size"), F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
        *([F.col(row).alias("row")] if row else []),
    )
    return (
        keys.join(F.broadcast(items), F.xxhash64(digest) == F.col("item"), "left_semi")
        .groupBy(digest)
        .agg(F.count("*").alias("rows"), F.min(first).alias("first"))
        .filter(F.col("rows") >= least)
        .select(
            F.col(digest).alias("heavy_digest"),
            F.col("rows").alias("heavy_rows"),
            (-F.col("first.size")).alias("top_size"),
            F.col("first.id").alias("top_id"),
            *([F.col("first.row").alias("top_row")] if row else []),
        )
    )


def split(keys: DataFrame, digest: str, row: str, winners: DataFrame):
    """Rows of heavy groups but the one that stays, and all others; both carry the winner."""
    joined = keys.join(F.broadcast(winners), F.col(digest) == F.col("heavy_digest"), "left")
    loses = F.col("heavy_digest").isNotNull() & (F.col(row) != F.col("top_row"))
    return joined.filter(loses), joined.filter(~loses)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    An empty table gives no rows.  Other columns are not read.
    """
    keys = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            digest_of(text_or_empty(text)).alias("digest"),
            F.length(text_or_empty(text)).alias("size"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    winners = materialise(heavy_winners(keys, "digest", "size", "doc_id", "row"))
    settled, others = split(keys, "digest", "row", winners)
    group = Window.partitionBy("digest")
    order = group.orderBy(F.col("size").desc(), F.col("doc_id").asc_nulls_last())
    settled = settled.select(
        "doc_id", F.col("top_id").alias("keep_id"), F.col("heavy_rows").alias("group_size"),
        F.lit(False).alias("kept"), "digest",
    )
    others = others.select(
        "doc_id",
        F.first("doc_id").over(order).alias("keep_id"),
        F.coalesce("heavy_rows", F.count("*").over(group)).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
        "digest",
    )
    return settled.unionAll(others).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of docs.

    Rows that tie in size and doc_id are ordered by their text.
    """
    digest, size = fresh(docs, "digest", "size")
    keyed = docs.withColumns(
        {digest: digest_of(text_or_empty(text)), size: F.length(text_or_empty(text))}
    )
    slim = keyed.select(
        F.col(digest).alias("digest"), F.col(size).alias("size"), F.col(doc_id).alias("doc_id")
    )
    winners = materialise(heavy_winners(slim, "digest", "size", "doc_id"))
    names = fresh(keyed, "heavy_digest", "heavy_rows", "top_size", "top_id", "place")
    joined = keyed.join(
        F.broadcast(winners.toDF(*names[:4])), F.col(digest) == F.col(names[0]), "left"
    ).filter(
        F.col(names[0]).isNull()
        | ((F.col(size) == F.col(names[2])) & F.col(doc_id).eqNullSafe(F.col(names[3])))
    )
    order = Window.partitionBy(digest).orderBy(
        F.col(size).desc(), F.col(doc_id).asc_nulls_last(), F.col(text)
    )
    return (
        joined.withColumn(names[4], F.row_number().over(order))
        .filter(F.col(names[4]) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
