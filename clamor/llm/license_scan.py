"""License scan by diagonal voting.

Every pair of neighbouring words of a text is hashed and joined to the positions
at which license templates hold the same pair.  A hit at word p of the text and
word j of the template votes for the diagonal p - j.  Diagonals with enough votes
that lie close together (words inserted or left out) are merged to one span, and a
span is verified by its words: hashes that met without equal words do not vote, and
enough positions of the template must be covered.  Texts are read once and the hits
are shuffled once, by text.

Short templates and the base phrases must stand consecutively and complete.  A null
or empty text has no words, no labels and score 0.  Rows that repeat a doc_id are
scanned one by one.  The largest group is the hits of one text.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clamor.llm.common import text_or_empty

# The words of a text, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrase and label.
BASE = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Wordings in common use: notice and label.
NOTICES = [
    ("under the mit license", "mit"),
    ("under the apache license version 2 0", "apache-2.0"),
    ("spdx license identifier mit", "mit"),
    ("spdx license identifier apache 2 0", "apache-2.0"),
    ("under cc by nc", "cc-by-nc"),
    ("under cc by sa", "cc-by-sa"),
    ("under cc by nd", "cc-by-nd"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("mozilla public license", "mpl"),
    ("released into the public domain", "public-domain"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "bsd",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "isc",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at",
        "apache-2.0",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        "gpl",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mpl-2.0",
    ),
    (
        "this is free and unencumbered software released into the public domain",
        "unlicense",
    ),
]

EXACT_WORDS = 8  # templates of up to so many words must be complete
COVERED = 0.7  # of a longer template's pairs, the share that must be found
VOTES = 0.2  # of a longer template's pairs, the share that one diagonal must hold
SLACK = 4  # words by which neighbouring diagonals may differ

_TEMPLATE = T.StructType(
    [
        T.StructField("template", T.IntegerType()),
        T.StructField("label", T.StringType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("pairs", T.IntegerType()),
        T.StructField("need", T.IntegerType()),
        T.StructField("votes_need", T.IntegerType()),
        T.StructField("slack", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("pair", T.StringType()),
    ]
)


def template_rows(base=BASE, notices=NOTICES) -> list[tuple]:
    """A row for each pair of neighbouring words of each template."""
    rows = []
    for k, (phrase, label) in enumerate([*base, *notices]):
        words = re.findall(WORD, phrase.lower())
        n = len(words) - 1
        exact = len(words) <= EXACT_WORDS
        need, votes = (n, n) if exact else (math.ceil(n * COVERED), math.ceil(n * VOTES))
        for j in range(n):
            pair = f"{words[j]} {words[j + 1]}"
            rows.append((k, label, k < len(base), n, need, votes, 0 if exact else SLACK, j, pair))
    return rows


def words_of(text: Column) -> Column:
    """Lower-cased words.  The Kelvin sign is the one other character whose lower case
    is a letter of a-z; it is replaced first, so that it matches no template."""
    lowered = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def template_table(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """The template pairs with their hash; one more row, of no template, has hash 0."""
    rows = spark.createDataFrame(template_rows(base, notices), _TEMPLATE)
    words = F.split("pair", " ")
    none = spark.createDataFrame([(None, None, None, None, 0, 0, 0, 0, None)], _TEMPLATE)
    return rows.withColumn("key", F.xxhash64(F.get(words, F.lit(0)), F.get(words, F.lit(1)))).union(
        none.withColumn("key", F.lit(0).cast("long"))
    )


def pair_hits(docs: DataFrame, templates: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id, n_words and the template's columns for each hit at word p.

    Every text has one more row, whose template is null, to keep texts without hits.
    """
    read = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        words_of(text_or_empty(text)).alias("words"),
    )
    n = F.size("words")
    hashes = F.when(
        n > 1,
        F.transform(
            F.sequence(F.lit(0), n - 2),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    placed = read.select(
        "row", "doc_id", "words", n.cast("long").alias("n_words"),
        F.concat(hashes, F.array(F.lit(0).cast("long"))).alias("hashes"),
    ).select("row", "doc_id", "words", "n_words", F.posexplode("hashes").alias("p", "hash"))
    same = F.concat_ws(" ", F.get("words", F.col("p")), F.get("words", F.col("p") + 1))
    met = placed.join(
        F.broadcast(templates),  # a few hundred rows, set by the templates
        (F.col("hash") == F.col("key")) & (F.col("template").isNull() | (F.col("pair") == same)),
    )
    return met.select("row", "doc_id", "n_words", "p", *_TEMPLATE.names[:-1])


def spans(hits: DataFrame) -> DataFrame:
    """Spans that the words bear out: row, doc_id, n_words, label, base, start, end (in
    words), score; and the row of no template of each text."""
    of_template = ["row", "doc_id", "n_words", *_TEMPLATE.names[:7]]
    diagonals = (
        hits.repartition("row")
        .withColumn("diagonal", F.col("p") - F.col("j"))
        .groupBy(*of_template, "diagonal")
        .agg(F.min("p").alias("start"), F.max("p").alias("end"), F.collect_set("j").alias("js"))
        .filter(F.size("js") >= F.col("votes_need"))
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("slack")
    return (
        diagonals.withColumn("far", F.coalesce(far.cast("int"), F.lit(0)))
        .withColumn("span", F.sum("far").over(along))
        .groupBy(*of_template, "span")
        .agg(
            F.min("start").alias("start"),
            (F.max("end") + 2).alias("end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("js")))).alias("covered"),
        )
        .filter(F.col("covered") >= F.col("need"))
        .select(
            "row", "doc_id", "n_words", "label", "base", "start", "end",
            (F.col("covered") / F.col("pairs")).alias("score"),
        )
    )


def license_scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", base=BASE, notices=NOTICES
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    base and notices are pairs of a phrase of two words or more and its label.  The
    score is the largest share of a template that a span covers, 0 without a span.
    """
    found = spans(pair_hits(docs, template_table(docs.sparkSession, base, notices), doc_id, text))
    of_base = F.when(F.col("base"), F.col("start").cast("long"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    return (
        found.groupBy("row", "doc_id", "n_words")
        .agg(
            F.count(of_base).alias("n_base"),
            F.min(of_base).alias("first_word"),
            F.max(of_base).alias("last_word"),
            joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
            joined(F.col("label")).alias("labels"),
            F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
            F.count("label").alias("spans"),
        )
        .drop("row")
    )
