"""Token, clause and opinion detail of scored texts.

Every operator here explodes or projects within the row, so none of them moves
data between tasks.  ``keys`` are the columns that identify a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.functions import lexicon as lx
from clamor.functions.scoring import (
    CONTRAST_GAIN,
    break_places,
    clause_array,
    clause_opinions,
    clause_spans,
    gained,
    item_position,
    item_token,
    opinion_words,
    scored,
    with_clauses,
    with_opinions,
)
from clamor.functions.text import with_tokens, work_bound


def token_rows(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per token: keys, pos, token.

    The outer form keeps Spark from testing the size of the list beforehand: it
    would move that test below the projections and build the list twice.
    """
    found = with_tokens(df, text).select(*keys, F.posexplode_outer("tokens").alias("pos", "token"))
    return found.where(F.col("token").isNotNull())


def token_lexicon(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Lexicon entry of every token that has one: kind and value.

    The lexicon has a few hundred rows whatever the data, so it is broadcast.
    """
    lexicon = F.broadcast(lx.lexicon_frame(df.sparkSession))
    return token_rows(df, keys, text).join(lexicon, "token").select(
        *keys, "pos", "token", "kind", "value"
    )


def token_stats(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Tokens, decisions, opinions per text and the n log n bound of tokens."""
    return (
        with_tokens(df, text, "_tokens")
        .select(
            *keys,
            F.size("_tokens").alias("tokens"),
            F.size(scored("_tokens")).alias("decisions"),
            F.size(opinion_words("_tokens")).alias("opinions"),
        )
        .withColumn("bound", work_bound(F.col("tokens")))
    )


def clauses(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Clause number and contrast depth of every token.

    The outer forms keep Spark from testing the sizes of the lists beforehand, as in
    ``token_rows``: it would build them again inside the test.
    """
    return (
        with_tokens(df, text, "_tokens")
        .withColumn("_breaks", break_places("_tokens"))
        .withColumn("_spans", clause_spans("_tokens", "_breaks"))
        .select(*keys, F.inline_outer("_spans"))
        .select(*keys, "clause", "depth", "start", F.posexplode_outer("found").alias("_place", "token"))
        .where(F.col("token").isNotNull())
        .select(*keys, (F.col("start") + F.col("_place")).alias("pos"), "token", "clause", "depth")
    )


def opinions(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Every opinion with its clause, its scope and its signed weight."""
    return with_opinions(df, text).select(*keys, "clause", "depth", F.inline_outer("found"))


def _add(array: Column, value) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda total, x: total + value(x))


def clause_breakdown(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per clause with an opinion: what it says and how much it counts."""
    found = F.col("found")
    strongest = F.array_max(
        F.transform(
            found,
            lambda o: F.struct(
                F.abs(o["signed_weight"]).alias("size"),
                (-o["pos"]).alias("order"),
                o["token"].alias("token"),
                o["signed_weight"].alias("signed_weight"),
            ),
        )
    )
    return (
        with_opinions(df, text)
        .withColumn("_sum", _add(found, lambda o: o["signed_weight"]))
        .withColumn("_gain", F.pow(F.lit(CONTRAST_GAIN), F.col("depth")))
        .withColumn("_top", strongest)
        .select(
            *keys,
            "clause",
            F.array_join(F.transform(found, lambda o: o["token"]), " ").alias("tokens"),
            F.round("_sum", 4).alias("weight"),
            F.col("_top")["token"].alias("dominant"),
            F.round(F.col("_top")["signed_weight"], 4).alias("dominant_weight"),
            F.round("_gain", 4).alias("gain"),
            F.round(gained(F.col("_sum"), F.col("depth")), 4).alias("weighted"),
            (F.col("depth") > 0).alias("is_contrast"),
            F.exists(found, lambda o: o["negated"]).alias("is_negated"),
        )
    )


def raw_scores(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Raw score per text, summed from its clauses (0 without an opinion).

    The clauses of a text stay in its row until they are added up, each
    relative to the last one, whose gain is the largest.
    """
    last = F.col("_last")

    def clause_value(clause: Column) -> Column:
        total = _add(clause_opinions(clause["items"]), lambda o: o["signed_weight"])
        return total * F.pow(F.lit(CONTRAST_GAIN), clause["depth"] - last)

    return (
        with_tokens(df, text, "_tokens")
        .withColumn("_clauses", clause_array("_tokens", scored_only=True))
        .withColumn("_last", F.element_at("_clauses", -1)["depth"])
        .withColumn("_sum", _add(F.col("_clauses"), clause_value))
        .select(*keys, F.round(gained(F.col("_sum"), last), 6).alias("raw_score"))
    )


def opinions_ranked(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Opinions of each text by strength, ties in text order.

    All opinions of a text are sorted inside its row.
    """
    every = F.flatten(F.transform("_clauses", lambda c: clause_opinions(c["items"])))
    by_strength = F.sort_array(
        F.transform(
            every,
            lambda o: F.struct(
                (-F.abs(o["signed_weight"])).alias("order"),
                o["pos"].alias("pos"),
                o["token"].alias("token"),
                o["signed_weight"].alias("signed_weight"),
            ),
        )
    )
    return (
        with_tokens(df, text, "_tokens")
        .withColumn("_clauses", clause_array("_tokens", scored_only=True))
        .select(*keys, F.posexplode_outer(by_strength).alias("_rank", "o"))
        .where(F.col("o").isNotNull())
        .select(
            *keys,
            (F.col("_rank") + 1).alias("strength_rank"),
            "o.pos",
            "o.token",
            F.round("o.signed_weight", 6).alias("signed_weight"),
        )
    )
