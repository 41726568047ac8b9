"""Mention tables derived from the test tables, and their loaders.

``mentions`` gives every event one of the phrases below; ``document_mentions``
and ``turn_mentions`` take whole documents and conversation turns as texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clamor.session import configure, spread

# (text, label); two labels differ from the computed class on purpose.
PHRASES = [
    ("The support was excellent and very helpful", "POSITIVO"),
    ("Never again, awful delay and rude staff", "NEGATIVO"),
    ("Not terrible, but not great", "NEUTRAL"),
    ("Entrega rapida y atencion amable", "POSITIVO"),
    ("No es bonito ni comodo", "NEGATIVO"),
    ("Producto caro, sin embargo excelente", "POSITIVO"),
    ("Apenas cumple", "NEUTRAL"),
    ("Where is the store?", "NEUTRAL"),
    ("Extremadamente lento... odio esperar", "NEGATIVO"),
    ("Todo bien", "POSITIVO"),
    ("Super rapido, top, gracias", "POSITIVO"),
    ("@tienda http://t.example/x el envio roto!!!", "NEGATIVO"),
    ("¡Increíble diseño, niño feliz!", "POSITIVO"),
    ("Vino obstante malo", "NEGATIVO"),
    ("", "NEUTRAL"),
    ("No zapato azul, rojo bueno verde gris casa gato", "POSITIVO"),
    ("9.99 caro 😡", "NEGATIVO"),
    ("RT rt excelente", "POSITIVO"),
    ("helpful solid durable elegante comodo", "POSITIVO"),
    ("bueno bueno", "POSITIVO"),
]
BRANDS = ["acme", "globex", "initech"]
ROWS_PER_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)


def pick(values: list[str], index: str) -> str:
    """SQL expression: the value at an index from 0."""
    return f"element_at(array({_quoted(values)}), CAST({index} + 1 AS INT))"


def phrase(index: str) -> str:
    return pick([text for text, _ in PHRASES], f"{index} % 20")


def mentions(spark: SparkSession, sf_dir: str, even: bool = True) -> DataFrame:
    """One mention per event.

    Without ``even`` the events stay in the splits of their file, for cheap work on them.
    """
    label = pick([label for _, label in PHRASES], "event_id % 20")
    events = table(spark, sf_dir, "events")
    if even:
        events = spread(events, "event_id")
    return events.selectExpr(
        "concat('m', event_id) AS mention_id",
        "CAST(ts AS timestamp) AS ts",
        f"{pick(BRANDS, 'event_id % 3')} AS brand",
        "CASE event_id % 4 WHEN 1 THEN '' WHEN 2 THEN 'feed_a' WHEN 3 THEN 'feed_b' END AS source",
        "event_type AS platform",
        "concat('user_', user_id) AS author",
        "CAST(user_id * 37 % 9000 AS INT) AS author_followers",
        f"{phrase('event_id')} AS text",
        "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'en' ELSE 'es' END AS lang",
        "CASE event_id % 4 WHEN 1 THEN array('launch') WHEN 2 THEN array('launch', 'review') "
        "WHEN 3 THEN array('review', 'review') END AS hashtags",
        "CAST(event_id % 50 AS INT) AS likes",
        "CAST(event_id % 7 AS INT) AS shares",
        f"CASE WHEN event_id % 7 <> 3 THEN {label} END AS expected",
        f"event_id DIV {ROWS_PER_BATCH} AS batch_id",
        "CAST(ts AS timestamp) AS processed_at",
    )


def raw_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mentions`` with copies and with missing authors, texts and ids."""
    base = mentions(spark, sf_dir).withColumn(
        "_n", F.substring("mention_id", 2, 20).cast("long")
    )
    copies = F.when(F.col("_n") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        base.withColumn("_copy", F.explode(copies))
        .withColumn("author", F.when(F.col("_n") % 97 != 0, F.col("author")))
        .withColumn("text", F.when(F.col("_n") % 89 != 0, F.col("text")))
        .withColumn("mention_id", F.when(F.col("_n") % 83 != 0, F.col("mention_id")))
        .drop("_n", "_copy")
    )


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, each followed by a phrase, as (mention_id, text)."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return documents.selectExpr(
        "concat('d', doc_id) AS mention_id",
        f"concat_ws(' ', text, {phrase('doc_id')}) AS text",
    )


def turn_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns, each followed by a phrase; roles act as platforms."""
    turns = spread(table(spark, sf_dir, "conversations"), "conv_id")
    return turns.selectExpr(
        "concat('c', conv_id, '_', turn) AS mention_id",
        f"{pick(BRANDS, 'conv_id % 3')} AS brand",
        "role AS platform",
        "concat('conv_', conv_id) AS author",
        f"concat_ws(' ', text, {phrase('(conv_id + turn)')}) AS text",
    )
