"""Graph of the messages of one session: brand as one node, four relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clamor.functions.scoring import NEGATIVE, NEUTRAL, POSITIVE
from clamor.operators.graph import edges_among, node_id
from clamor.operators.mentions import dedupe
from clamor.session import materialise

BRAND_NODE = "MARCA"
KEPT_NODES = 160
STEPS = 1 << 31  # places inside a message


def majority(pos: str = "pos", neu: str = "neu", neg: str = "neg") -> Column:
    """Most frequent class; ties go to positive, then negative."""
    p, u, n = F.col(pos), F.col(neu), F.col(neg)
    return (
        F.when((p >= u) & (p >= n), POSITIVE).when(n >= u, NEGATIVE).otherwise(NEUTRAL)
    )


def _first_seen(messages: DataFrame) -> DataFrame:
    """One row per mention, the earliest by (ts, mention_id)."""
    return dedupe(
        messages.select("mention_id", "ts", "author", "platform", "keywords", "sentiment")
    )


def _ordered(messages: DataFrame) -> DataFrame:
    """The written messages with their place ``n`` (from 0) by time, then by mention.

    The window sees one row for each sorted part.
    """
    ranked = materialise(
        messages.orderBy("ts", "mention_id").withColumn("_id", F.monotonically_increasing_id())
    )
    # The id holds the part above 33 bits and the place in it below.
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranked.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        ranked.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .withColumn("n", F.col("_start") + place).drop("_id", "_part", "_start")
    )


# Elements in the order in which a message touches them: label, relation, source, target.
# The words of a message come last, each as a node and an edge.
CENTRE = ("MARCA", None)
KINDS = [
    ("MARCA", None, CENTRE, None),
    ("USUARIO", None, ("USUARIO", "first"), None),
    (None, "MENCIONA", ("USUARIO", "first"), CENTRE),
    ("PLATAFORMA", None, ("PLATAFORMA", "first"), None),
    (None, "PUBLICA", ("USUARIO", "first"), ("PLATAFORMA", "second")),
    (None, "EN_PLATAFORMA", CENTRE, ("PLATAFORMA", "first")),
    ("PALABRA", None, ("PALABRA", "first"), None),
    (None, "APARECE_EN", ("PALABRA", "first"), CENTRE),
]
FIXED = 6  # kinds that do not belong to a word


def _of_kind(values: list[Column]) -> Column:
    found = F.lit(None).cast("string")
    for kind, value in enumerate(values):
        found = F.when(F.col("kind") == kind, value).otherwise(found)
    return found


def _end(place: int) -> Column:
    ends = [kind[place] for kind in KINDS]
    return _of_kind(
        [
            F.lit(None).cast("string") if end is None
            else F.lit(BRAND_NODE) if end is CENTRE
            else node_id(end[0], F.col(end[1]))
            for end in ends
        ]
    )


def _touches(messages: DataFrame) -> DataFrame:
    """One row per message and element it touches, as kind and plain names."""
    units = messages.select(
        "n", "author", F.nullif("platform", F.lit("")).alias("platform"), "sentiment",
        # The first unit stands for the kinds without a word.
        F.posexplode_outer(
            F.concat(
                F.array(F.lit(None).cast("string")),
                F.coalesce("keywords", F.array().cast("array<string>")),
            )
        ).alias("unit", "word"),
    )
    none = F.lit(None).cast("string")
    author, platform, word = F.col("author"), F.col("platform"), F.col("word")
    names = [
        (F.lit(""), none), (author, none), (author, none), (platform, none),
        (F.when(platform.isNotNull(), author), platform), (platform, none), (word, none), (word, none),
    ]
    parts = [
        F.struct(F.lit(k).alias("kind"), first.alias("first"), second.alias("second"))
        for k, (first, second) in enumerate(names)
    ]
    every = F.when(F.col("unit") == 0, F.array(*parts[:FIXED])).otherwise(F.array(*parts[FIXED:]))
    step = F.when(F.col("unit") == 0, F.col("kind")).otherwise(F.col("kind") + 2 * F.col("unit") - 2)
    return (
        units.select("n", "sentiment", "unit", F.inline_outer(every))
        .where(F.col("first").isNotNull())
        .withColumn("touch", F.col("n") * STEPS + step)
    )


def session_elements(messages: DataFrame, brand: str = "Marca") -> DataFrame:
    """Nodes (``dst`` null) and edges with class counts and last touch.

    Messages touch their elements one after another: touches are ordered by time, then
    by mention, then by the place inside the message.  One number stands for this order,
    so elements are counted in hash tables and no touch is sorted.
    """
    ordered = _ordered(materialise(_first_seen(messages)))
    counted = (
        _touches(ordered).groupBy("kind", "first", "second")
        .agg(
            F.count("*").alias("weight"),
            F.count_if(F.col("sentiment") == POSITIVE).alias("pos"),
            F.count_if(~F.coalesce(F.col("sentiment"), F.lit("")).isin(POSITIVE, NEGATIVE)).alias("neu"),
            F.count_if(F.col("sentiment") == NEGATIVE).alias("neg"),
            F.max("touch").alias("touch"),
        )
        .withColumn("n", F.expr(f"touch DIV {STEPS}"))
    )
    last = F.struct("ts", "mention_id", (F.col("touch") % STEPS).cast("int").alias("place"))
    is_node = [kind[0] is not None for kind in KINDS]
    names = [
        F.lit(brand) if kind[0] == "MARCA" else F.col("first") if node else F.lit(None).cast("string")
        for kind, node in zip(KINDS, is_node)
    ]
    return (
        counted.join(ordered.select("n", "ts", "mention_id"), "n")
        .select(
            _end(2).alias("src"), _of_kind([F.lit(k[0]).cast("string") for k in KINDS]).alias("label"),
            _of_kind(names).alias("name"), _end(3).alias("dst"),
            _of_kind([F.lit(k[1]).cast("string") for k in KINDS]).alias("rel"),
            "weight", "pos", "neu", "neg", last.alias("last_touch"),
        )
        .withColumn("sentiment", majority())
    )


def capped(elements: DataFrame, keep: int = KEPT_NODES) -> DataFrame:
    """The brand and the most recently touched other nodes, ``keep`` in all,
    with the edges that still have both ends.

    ``elements`` is read twice and should be a written table.
    """
    nodes = elements.where(F.col("dst").isNull())
    brand = nodes.where(F.col("src") == BRAND_NODE)
    recent = (
        nodes.where(F.col("src") != BRAND_NODE).orderBy(F.desc("last_touch"), "src").limit(keep - 1)
    )
    kept = brand.unionByName(recent)
    edges = elements.where(F.col("dst").isNotNull())
    inside = edges_among(edges, kept.select(F.col("src").alias("node_id")))
    return kept.unionByName(inside)


def session_graph(messages: DataFrame, brand: str = "Marca", keep: int | None = None) -> DataFrame:
    """Session nodes and edges, optionally capped to the most recent nodes."""
    elements = session_elements(messages, brand)
    return elements if keep is None else capped(materialise(elements), keep)
