"""Co-occurrence graph of brands, authors, platforms, tags and keywords.

``graph_elements`` builds nodes and edges in one pass: every fact is exploded
into its contributions and one aggregate adds them up.  The aggregate combines
in each task before the shuffle, so a brand or tag in a third of all facts
arrives at its reducer as one row per task.

Scores have six decimals; sums are taken over whole millionths and are
therefore the same for every partitioning and batching.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clamor.functions.scoring import NEGATIVE, NEUTRAL, POSITIVE, sentiment_class
from clamor.session import materialise

MILLION = 1_000_000

NODE_KEYS = ["node_id", "label", "name"]
EDGE_KEYS = ["src", "dst", "rel"]
NODE_SUMS = ["weight", "pos", "neu", "neg", "score_sum"]
EDGE_SUMS = ["weight", "score_sum"]

# The label of the entities in each column, the columns that hold lists,
# and the relations as source, target and name.
SINGLE = {"MARCA": "brand", "USUARIO": "author", "PLATAFORMA": "platform"}
LISTED = {"HASHTAG": "hashtags", "PALABRA": "keywords"}
RELATIONS = [
    ("USUARIO", "MARCA", "MENCIONA"),
    ("USUARIO", "PLATAFORMA", "PUBLICA"),
    ("MARCA", "PLATAFORMA", "EN_PLATAFORMA"),
    ("USUARIO", "HASHTAG", "ETIQUETA"),
    ("MARCA", "HASHTAG", "CON_HASHTAG"),
    ("PALABRA", "MARCA", "APARECE_EN"),
    ("PALABRA", "USUARIO", "USA"),
]
# Elements by number: nodes by their label, then the relations.
KINDS = [(label, None, None) for label in [*SINGLE, *LISTED]] + RELATIONS
NODE_KINDS = len(SINGLE) + len(LISTED)

ALWAYS_KEPT = ["MARCA", "PLATAFORMA"]
KEEP_PER_LABEL = 90
KEPT_SENT = 500_000  # kept nodes that are sent to all tasks at most
SLICE_SIZE = 140


# --------------------------------------------------------------------------
# Contributions
# --------------------------------------------------------------------------


def _named(value: Column) -> Column:
    """Entity name, null if missing or empty."""
    return F.nullif(value, F.lit(""))


def node_id(label: str, name: Column) -> Column:
    return F.concat(F.lit(f"{label}:"), name)


def edge_id(src: str = "src", dst: str = "dst", rel: str = "rel") -> Column:
    return F.concat(F.col(src), F.lit("->"), F.col(dst), F.lit(":"), F.col(rel))


def _list(name: str) -> Column:
    """A list column; a null one is empty."""
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def _parts(facts: DataFrame, carried: list[str], kinds: range) -> DataFrame:
    """One row per fact and element as (kind, first, second), the plain names.

    A fact is exploded into what it names once, and this into elements: arrays of
    fixed length, which Spark compiles.  A kind is a place in KINDS; nodes have no
    second name.
    """
    single = {label: _named(F.col(name)).alias(f"_{label}") for label, name in SINGLE.items()}
    lists = [_list(name) for name in LISTED.values()]
    named = facts.select(
        *carried, *single.values(), F.size(lists[0]).alias("_tags"),
        # The first unit stands for the single names.
        F.concat(F.array(F.lit(None).cast("string")), *lists).alias("_units"),
    )
    units = named.select(
        *carried, *[f"_{label}" for label in SINGLE], "_tags",
        F.posexplode_outer("_units").alias("_place", "_value"),
    )

    def end(label: str | None) -> Column:
        if label is None:
            return F.lit(None).cast("string")
        return F.col(f"_{label}" if label in SINGLE else "_value")

    def parts_of(listed: str | None) -> Column:
        own = [k for k in kinds if next((e for e in KINDS[k][:2] if e in LISTED), None) == listed]
        return F.array(
            *[
                F.struct(
                    F.lit(k).alias("kind"), end(KINDS[k][0]).alias("first"),
                    end(KINDS[k][1]).alias("second"),
                )
                for k in own
            ]
        )

    tags, words = LISTED
    every = (
        F.when(F.col("_place") == 0, parts_of(None))
        .when(F.col("_place") <= F.col("_tags"), parts_of(tags))
        .otherwise(parts_of(words))
    )
    return units.select(*carried, F.inline_outer(every)).where(
        F.col("first").isNotNull() & ((F.col("kind") < NODE_KINDS) | F.col("second").isNotNull())
    )


def _of_kind(values: list[str | None]) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), F.col("kind") + 1)


def _end(place: int, name: str) -> Column:
    """Node id of one end of an element; null where it has none."""
    return F.concat(_of_kind([k[place] and f"{k[place]}:" for k in KINDS]), F.col(name))


def node_contributions(facts: DataFrame, *extra: str) -> DataFrame:
    """One row per fact and entity; repeated tags and keywords count again."""
    carried = [*extra, "sentiment", "score"]
    return _parts(facts, carried, range(NODE_KINDS)).select(
        *carried, _end(0, "first").alias("node_id"),
        _of_kind([k[0] for k in KINDS]).alias("label"), F.col("first").alias("name"),
    )


def edge_contributions(facts: DataFrame, *extra: str) -> DataFrame:
    """One row per fact and relation whose two ends are present."""
    carried = [*extra, "sentiment", "score"]
    return _parts(facts, carried, range(NODE_KINDS, len(KINDS))).select(
        *carried, _end(0, "first").alias("src"), _end(1, "second").alias("dst"),
        _of_kind([k[2] for k in KINDS]).alias("rel"),
    )


def edge_contributions_joined(facts: DataFrame) -> DataFrame:
    """The same edges as one equi join of the entities of each fact.

    For entities that are stored as a table of their own.  The relations are a constant
    of seven rows.
    """
    entities = node_contributions(facts, "mention_id")
    relations = facts.sparkSession.createDataFrame(
        RELATIONS, "label string, dst_label string, rel string"
    )
    sources = entities.join(F.broadcast(relations), "label").select(
        "mention_id", "dst_label", F.col("node_id").alias("src"), "rel", "sentiment", "score"
    )
    targets = entities.select(
        "mention_id", F.col("label").alias("dst_label"), F.col("node_id").alias("dst")
    )
    return sources.join(targets, ["mention_id", "dst_label"]).select(
        "src", "dst", "rel", "sentiment", "score"
    )


# --------------------------------------------------------------------------
# Aggregates
# --------------------------------------------------------------------------


def _count_class(label: str) -> Column:
    return F.count_if(F.col("sentiment") == label)


def score_total(score: str = "score") -> Column:
    return F.sum(F.round(F.col(score) * MILLION).cast("long")) / MILLION


def aggregate_nodes(contributions: DataFrame, *extra: str) -> DataFrame:
    return contributions.groupBy(*extra, *NODE_KEYS).agg(
        F.count("*").alias("weight"),
        _count_class(POSITIVE).alias("pos"),
        _count_class(NEUTRAL).alias("neu"),
        _count_class(NEGATIVE).alias("neg"),
        score_total().alias("score_sum"),
    )


def aggregate_edges(contributions: DataFrame, *extra: str) -> DataFrame:
    return contributions.groupBy(*extra, *EDGE_KEYS).agg(
        F.count("*").alias("weight"), score_total().alias("score_sum")
    )


def merge_nodes(parts: DataFrame) -> DataFrame:
    """Key-wise sum of node aggregates, such as those of several batches."""
    counts = [F.sum(c).alias(c) for c in NODE_SUMS[:-1]]
    return parts.groupBy(*NODE_KEYS).agg(*counts, score_total("score_sum").alias("score_sum"))


def merge_edges(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*EDGE_KEYS).agg(
        F.sum("weight").alias("weight"), score_total("score_sum").alias("score_sum")
    )


def graph_nodes(facts: DataFrame) -> DataFrame:
    return aggregate_nodes(node_contributions(facts))


def graph_edges(facts: DataFrame) -> DataFrame:
    return aggregate_edges(edge_contributions(facts))


def with_sentiment(elements: DataFrame) -> DataFrame:
    """Class of the mean score of a node or edge."""
    mean = F.try_divide(F.col("score_sum"), F.col("weight"))
    return elements.withColumn("sentiment", sentiment_class(mean))


def graph_elements(facts: DataFrame, *extra: str) -> DataFrame:
    """Nodes (``dst`` null) and edges in one table, from one pass over facts.

    Plain names are counted; ids are built for the elements that come out.
    """
    sentiment = F.col("sentiment")
    sign = F.when(sentiment == POSITIVE, 1).when(sentiment == NEUTRAL, 0).when(sentiment == NEGATIVE, -1)
    carried = {"_sign": sign, "_micros": F.round(F.col("score") * MILLION).cast("long")}
    parts = _parts(facts.withColumns(carried), [*extra, *carried], range(len(KINDS)))
    counted = parts.groupBy(*extra, "kind", "first", "second").agg(
        F.count("*").alias("weight"),
        F.count_if(F.col("_sign") == 1).alias("pos"),
        F.count_if(F.col("_sign") == 0).alias("neu"),
        F.count_if(F.col("_sign") == -1).alias("neg"),
        (F.sum("_micros") / MILLION).alias("score_sum"),
    )
    is_node = F.col("kind") < NODE_KINDS
    return counted.select(
        *extra,
        _end(0, "first").alias("src"),
        F.when(is_node, _of_kind([k[0] for k in KINDS])).alias("label"),
        F.when(is_node, F.col("first")).alias("name"),
        _end(1, "second").alias("dst"),
        _of_kind([k[2] for k in KINDS]).alias("rel"),
        *NODE_SUMS,
    )


def split_elements(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    is_node = F.col("dst").isNull()
    nodes = elements.where(is_node).withColumnRenamed("src", "node_id").drop("dst", "rel")
    edges = elements.where(~is_node).drop("label", "name", "pos", "neu", "neg")
    return nodes, edges


def build_graph(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) with their class, written once to the shared folder."""
    return split_elements(with_sentiment(materialise(graph_elements(facts))))


# --------------------------------------------------------------------------
# Selections
# --------------------------------------------------------------------------


def top_nodes(nodes: DataFrame, per_label: int = KEEP_PER_LABEL) -> DataFrame:
    """The heaviest nodes of each label; brands and platforms are all kept.

    A kept label ranks each node in a group of its own, so one condition on the
    rank selects everything and Spark cuts each task to its best rows before
    the shuffle.  A first ranking by slices of a label bounds what the second
    one sees, also where the limit is too large for that cut.
    """
    strength = [F.desc("weight"), F.desc(F.abs("score_sum") / F.col("weight")), F.asc("node_id")]
    group = F.when(F.col("label").isin(ALWAYS_KEPT), F.col("node_id"))
    marked = nodes.withColumn("_group", group).withColumn(
        "_slice", F.pmod(F.xxhash64("node_id"), F.lit(256))
    )
    slices = Window.partitionBy("label", "_group", "_slice").orderBy(*strength)
    labels = Window.partitionBy("label", "_group").orderBy(*strength)
    return (
        marked.withColumn("_rank", F.row_number().over(slices))
        .where(F.col("_rank") <= per_label)
        .withColumn("_rank", F.row_number().over(labels))
        .where(F.col("_rank") <= per_label)
        .drop("_group", "_slice", "_rank")
    )


def edges_among_kept(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges with both ends in a written table of kept nodes.

    These are counted once; up to KEPT_SENT of them are sent to the edges, which then stay
    where they are.  Of more, Spark chooses the join.
    """
    ids = kept.select("node_id")
    return edges_among(edges, F.broadcast(ids) if ids.count() <= KEPT_SENT else ids)


def edges_among(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends in ``nodes``, which are read twice.

    Where the caller knows a bound of ``nodes`` it marks them for broadcast.
    """
    src = nodes.select(F.col("node_id").alias("src"))
    dst = nodes.select(F.col("node_id").alias("dst"))
    return edges.join(src, "src", "left_semi").join(dst, "dst", "left_semi")


def slice_nodes(nodes: DataFrame, limit: int = SLICE_SIZE) -> DataFrame:
    """Brands first, then by weight: the first ``limit`` nodes."""
    if not 10 <= limit <= 1000:
        raise ValueError("limit must be between 10 and 1000")
    order = [F.desc(F.col("label") == "MARCA"), F.desc("weight"), F.asc("node_id")]
    return nodes.orderBy(*order).limit(limit)


def slice_edges(edges: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edges inside the slice, heaviest first, with an id.

    ``edges`` holds one row for each edge, and a slice at most 1000 nodes, so the slice
    is sent to the edges and these are not shuffled.
    """
    return (
        edges_among(edges, F.broadcast(chosen))
        .withColumn("edge_id", edge_id())
        .orderBy(F.desc("weight"), "edge_id")
    )


def label_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("label").agg(F.count("*").alias("nodes"))


def list_nodes(nodes: DataFrame, limit: int = 100) -> DataFrame:
    return nodes.orderBy("node_id").limit(limit)


def of_kinds(nodes: DataFrame, kinds: list[str]) -> DataFrame:
    return nodes.where(F.col("label").isin(kinds))


def visible_nodes(nodes: DataFrame, kinds: list[str], top: int = 30) -> DataFrame:
    """All brands, and the heaviest other nodes of the chosen kinds up to ``top``.

    The ranking window sees at most ``top`` rows, those a distributed top-k
    leaves over.
    """
    chosen = of_kinds(nodes, kinds)
    brands = chosen.where(F.col("label") == "MARCA")
    strength = [F.desc("weight"), F.asc("node_id")]
    room = F.lit(top) - brands.agg(F.count("*")).scalar()
    others = (
        chosen.where(F.col("label") != "MARCA")
        .orderBy(*strength)
        .limit(top)
        .withColumn("_rank", F.row_number().over(Window.orderBy(*strength)))
        .where(F.col("_rank") <= room)
        .drop("_rank")
    )
    return brands.unionByName(others)


def neighbourhood(
    nodes: DataFrame, edges: DataFrame, centre: str
) -> tuple[DataFrame, DataFrame]:
    """A node, its neighbours either way, and the edges that connect them."""
    connecting = edges.where((F.col("src") == centre) | (F.col("dst") == centre))
    ends = connecting.select(F.explode(F.array("src", "dst")).alias("node_id"))
    itself = nodes.sparkSession.range(1).select(F.lit(centre).alias("node_id"))
    members = nodes.join(ends.unionByName(itself).distinct(), "node_id", "left_semi")
    return members, connecting


def brand_neighbours(edges: DataFrame, limit: int = 100) -> DataFrame:
    """Edges that touch a brand, direction ignored, heaviest first."""
    touches = F.col("src").startswith("MARCA:") | F.col("dst").startswith("MARCA:")
    return edges.where(touches).orderBy(F.desc("weight"), "src", "dst", "rel").limit(limit)


def scaled(elements: DataFrame, constant: float) -> DataFrame:
    """Display size: log weight scaled to 0..1 over the set.

    ``constant`` stands in where all sizes are equal.  The bounds come from an
    ordinary aggregate, not from a window over everything.
    """
    logged = F.log(F.greatest(F.lit(2), F.col("weight")))
    bounds = elements.agg(F.min(logged).alias("lo"), F.max(logged).alias("hi"))
    low, high = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    size = F.when(high > low, (logged - low) / (high - low)).otherwise(F.lit(constant))
    return elements.withColumn("size", F.round(size, 6))


NODE_CONSTANT, EDGE_CONSTANT = 0.6, 0.5


def merge_elements(parts: DataFrame) -> DataFrame:
    """Key-wise sum of ``graph_elements`` tables, such as those of batches."""
    counts = [F.sum(c).alias(c) for c in NODE_SUMS[:-1]]
    return parts.groupBy("src", "label", "name", "dst", "rel").agg(
        *counts, score_total("score_sum").alias("score_sum")
    )
