"""Record shapes and the fixed values that belong to them."""

from __future__ import annotations

from pyspark.sql import types as T

# Labels and defaults as stored.
CLASSES = ["POSITIVO", "NEUTRAL", "NEGATIVO"]
DEFAULT_SOURCE = "desconocida"
DEFAULT_LANG = "es"
UNLABELLED = "SIN_ETIQUETA"

MESSAGE = T.StructType(
    [
        T.StructField("mention_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("brand", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("author_followers", T.IntegerType()),
        T.StructField("likes", T.IntegerType()),
        T.StructField("shares", T.IntegerType()),
        T.StructField("expected", T.StringType()),
    ]
)

# Columns of a stored mention, in order.
FACT_COLUMNS = [
    "mention_id", "ts", "brand", "source", "platform", "author", "author_followers", "text",
    "lang", "hashtags", "keywords", "sentiment", "score", "confidence", "tokens", "opinions",
    "decisions", "expected", "likes", "shares",
]
