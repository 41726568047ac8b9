"""Text operators: normalise, collapse connectors, tokenise, extract tags.

The operators work on a DataFrame and add columns step by step: Spark keeps a
projection apart when a later one reads a costly column more than once, so each
step runs once per row.  Written as one nested expression, the same steps would
be evaluated again for every place that reads them.

One pass of ``regexp_extract_all`` yields words and punctuation runs together
("pieces").  Replacing everything else with blanks, rule by rule, would copy
the text each time and is several times slower on accented text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.functions import accents
from clamor.functions.lexicon import (
    COMMA_TOKEN,
    CONTRAST_TOKEN,
    PAUSE_TOKEN,
    PHRASES,
    in_list,
    stopwords,
)

# Blanks beyond the six that Java's \s knows.
BLANK = r"\s\x{1c}-\x{1f}\x{85}\x{1680}\x{2028}\x{2029}"
WORD_CHAR = r"\p{L}\p{N}_"
URL = rf"https?://[^{BLANK}]+|www\.[^{BLANK}]+"
USER = rf"@[{WORD_CHAR}]+"
PAUSE = r"\.\.\.|[.!?;:]+"
COMMA = r",+"
PIECES = rf"[a-z0-9#'_]+|{PAUSE}|{COMMA}"


# --------------------------------------------------------------------------
# Steps, Column to Column
# --------------------------------------------------------------------------


def fold(text: Column) -> Column:
    """Lower case, then accents folded."""
    return accents.strip_accents(F.lower(text))


def drop_links(folded: Column) -> Column:
    """URLs and ``@user`` become blanks; texts without either are not scanned."""
    candidate = folded.contains("http") | folded.contains("www.") | folded.contains("@")
    cleaned = F.regexp_replace(F.regexp_replace(folded, URL, " "), USER, " ")
    return F.when(candidate, cleaned).otherwise(folded)


def pieces(clean: Column) -> Column:
    """Words and punctuation runs in text order; all else only separates."""
    return F.regexp_extract_all(clean, F.lit(PIECES), F.lit(0))


def is_punctuation(piece: str) -> str:
    """SQL condition on a piece."""
    return f"substring({piece}, 1, 1) {in_list('.!?;:,')}"


def tokens_sql(found: str) -> str:
    return (
        f"transform({found}, p -> CASE WHEN startswith(p, ',') THEN '{COMMA_TOKEN}' "
        f"WHEN {is_punctuation('p')} THEN '{PAUSE_TOKEN}' ELSE p END)"
    )


def as_tokens(found: str) -> Column:
    """Pieces with each punctuation run as its sentinel."""
    return F.expr(tokens_sql(found))


def collapse_phrases(joined: Column) -> Column:
    """Two-word connectors become the contrast token, wherever they occur."""
    marker = F.lit(f" {CONTRAST_TOKEN} ")
    return reduce(lambda t, phrase: F.replace(t, F.lit(phrase), marker), PHRASES, joined)


def may_collapse_sql(clean: str) -> str:
    """Whether a text holds both words of a connector."""
    pairs = [phrase.split() for phrase in PHRASES]
    return " OR ".join(
        f"(contains({clean}, '{x}') AND contains({clean}, '{y}'))" for x, y in pairs
    )


def collapsed_pieces(found: str, clean: str) -> Column:
    """Pieces with connectors collapsed.

    Only texts that hold both words of a connector are joined and split again.
    """
    joined = collapse_phrases(F.array_join(found, " "))
    return F.when(F.expr(may_collapse_sql(clean)), F.split(joined, " ")).otherwise(F.col(found))


def meaningful_sql(found: str) -> str:
    return (
        f"filter({found}, p -> (length(p) > 1 OR {is_punctuation('p')}) "
        f"AND NOT p {in_list(stopwords)})"
    )


def meaningful(found: str) -> Column:
    """Punctuation, and words of two characters or more but stopwords."""
    return F.expr(meaningful_sql(found))


def extract_hashtags(text: Column) -> Column:
    """Distinct names after ``#`` or ``@`` in first-seen order, lower case."""
    pattern = rf"[@#]([{WORD_CHAR}][{WORD_CHAR}.-]*)"
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))
    cleaned = F.transform(found, lambda t: F.regexp_replace(t, "[^a-z0-9_#]", ""))
    return F.array_distinct(F.filter(cleaned, lambda t: t != ""))


def work_bound(n: Column) -> Column:
    """``ceil(n log2 n - n + 1)`` for n above 1, else 0."""
    exact = F.ceil(n * F.log2(n) - n + 1).cast("long")
    return F.when(n > 1, exact).otherwise(F.lit(0).cast("long"))


# --------------------------------------------------------------------------
# Operators, DataFrame to DataFrame
# --------------------------------------------------------------------------


def with_clean(df: DataFrame, text: str, out: str) -> DataFrame:
    folded = df.withColumn("_folded", fold(F.col(text)))
    return folded.withColumn(out, drop_links(F.col("_folded"))).drop("_folded")


def with_normalized(df: DataFrame, text: str = "text", out: str = "normalized") -> DataFrame:
    """Lower case, no accents, links or users; clause punctuation as sentinels."""
    return (
        with_clean(df, text, "_clean")
        .withColumn("_found", pieces(F.col("_clean")))
        .withColumn(out, F.array_join(as_tokens("_found"), " "))
        .drop("_clean", "_found")
    )


def with_pieces(df: DataFrame, text: str = "text", out: str = "pieces") -> DataFrame:
    """Meaningful words and punctuation runs, connectors collapsed."""
    return (
        with_clean(df, text, "_clean")
        .withColumn("_found", pieces(F.col("_clean")))
        .withColumn("_found", collapsed_pieces("_found", "_clean"))
        .withColumn(out, meaningful("_found"))
        .drop("_clean", "_found")
    )


def with_tokens(df: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
    """Meaningful tokens in text order, repeats kept, punctuation as sentinels."""
    return with_pieces(df, text, "_pieces").withColumn(out, as_tokens("_pieces")).drop("_pieces")
