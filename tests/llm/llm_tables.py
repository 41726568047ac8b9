"""Small tables with the awkward rows that every operator has to bear."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first_id=0, schema=DOCUMENTS):
    rows = [
        (first_id + k, t, "en", "src0", None if t is None else len(t)) for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, schema)


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows."""
    rows = [
        (0, "one two three four five six", "en", "a", 27),
        (1, None, None, None, None),
        (2, "", "", "", 0),
        (None, "one two three four five six", None, None, None),
        (3, " \t\n ", "de", "b", 4),
        (4, "word " * 60_000, "en", "a", 300_000),
        (5, "x" * 50_000, "en", "a", 50_000),
        (0, "one two three four five six", "en", "a", 27),
        (6, "größer als Ωmega ١٢٣ 𝒳 cc by", "de", "c", 30),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(df, *names):
    """df with further columns of the given names."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("mine"))
    return df
