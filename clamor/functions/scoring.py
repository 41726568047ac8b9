"""Clause-scoped sentiment as expressions over one row.

A token list is read left to right.  A clause break ends the scope of negators
and modifiers; a contrast word also raises the weight of what follows.  The
production form (``with_scores``) folds the scored tokens of a row into four
numbers, so its state is bounded, its cost linear in the text, and no row moves
between tasks.  ``with_opinions`` gives the detail behind a score, also within
the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.functions import lexicon as lx
from clamor.functions.text import is_punctuation, with_pieces, with_tokens

# Fixed values of the scoring rule.
CONTRAST_GAIN = 1.9
SCORE_SCALE = 1.9
NEUTRAL_BAND = 0.06
CONFIDENCE_FULL = 2.2
CONFIDENCE_BASE = 0.6
CONFIDENCE_SUPPORT = 0.4
SUPPORT_OPINIONS = 3
MAX_KEYWORDS = 4

BLOCK = 64  # modifiers whose product is taken at once
FEW_CODES = 16  # codes that are cheaper to fold as they are than to thin out before

POSITIVE, NEUTRAL, NEGATIVE = "POSITIVO", "NEUTRAL", "NEGATIVO"

# One integer per scored token, so that the fold compares numbers only:
# opinion weights in hundredths, then factors, then the structural roles.
FACTOR_BASE, NEGATOR_CODE, BREAK_CODE, CONTRAST_CODE = 1000, 2000, 3000, 4000


def _hundredths(value: float) -> int:
    """A weight or factor as a code; one that does not fit is refused, not rounded."""
    code = round(100 * value)
    if abs(100 * value - code) > 1e-9 or abs(code) >= FACTOR_BASE:
        raise ValueError(f"{value} is no number of hundredths below {FACTOR_BASE}")
    return code


def _token_codes() -> dict[str, int]:
    """Code per token; frequent roles first, as lookups scan in this order."""
    codes = dict.fromkeys(sorted(lx.clause_breaks), BREAK_CODE)
    codes |= dict.fromkeys(sorted(lx.contrasts), CONTRAST_CODE)
    codes |= dict.fromkeys(sorted(lx.negators), NEGATOR_CODE)
    codes |= {t: FACTOR_BASE + _hundredths(f) for t, f in lx.active_modifiers.items()}
    codes |= {t: _hundredths(w) for t, w in lx.active_opinions.items()}
    return codes


def _codes_by_length() -> str:
    """SQL expression: the token codes as one map for each length of a token, from 0.

    A lookup scans its map, so it passes the tokens of one length only.
    """
    codes = _token_codes()
    if not all(t.isascii() for t in codes):
        raise ValueError("tokens are found by their bytes and must be ASCII")
    maps = []
    for length in range(max(map(len, codes)) + 1):
        own = {t: code for t, code in codes.items() if len(t) == length}
        maps.append(lx.map_of(own, "int") if own else "CAST(NULL AS map<string, int>)")
    return f"array({', '.join(maps)})"


def token_codes_sql(hits: str) -> str:
    """No token with a code starts like punctuation, so it is looked up first."""
    return (
        f"transform({hits}, p -> coalesce("
        f"try_element_at(get({_codes_by_length()}, octet_length(p)), p), "
        f"CASE WHEN {is_punctuation('p')} THEN {BREAK_CODE} END))"
    )


def token_codes(hits: str) -> Column:
    """Role and value of each scored piece as one integer."""
    return F.expr(token_codes_sql(hits))


def without_idle_breaks(codes: str) -> Column:
    """Codes without breaks at the start or right after another plain break.

    They change no state, and most scored pieces of a long text are such breaks.  Short
    lists keep them.
    """
    return F.expr(
        f"CASE WHEN size({codes}) <= {FEW_CODES} THEN {codes} ELSE filter({codes}, (c, i) -> "
        f"c <> {BREAK_CODE} OR (i > 0 AND get({codes}, i - 1) <> {BREAK_CODE})) END"
    )


def scored_sql(found: str) -> str:
    return f"filter({found}, p -> p {lx.in_list(lx.scored_tokens)} OR {is_punctuation('p')})"


def scored(found: str) -> Column:
    """Pieces or tokens with a role in the score."""
    return F.expr(scored_sql(found))


def opinion_words(found: str) -> Column:
    return F.expr(f"filter({found}, p -> p {lx.in_list(lx.active_opinions)})")


def clamp(value: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))


def sentiment_class(value: Column) -> Column:
    return (
        F.when(value > NEUTRAL_BAND, POSITIVE)
        .when(value < -NEUTRAL_BAND, NEGATIVE)
        .otherwise(NEUTRAL)
    )


def squash(raw: Column) -> Column:
    return F.tanh(raw / SCORE_SCALE)


def confidence(raw: Column, opinions: Column) -> Column:
    magnitude = F.least(F.lit(1.0), F.abs(raw) / CONFIDENCE_FULL)
    support = F.least(F.lit(1.0), opinions / F.lit(float(SUPPORT_OPINIONS)))
    return F.round(magnitude * (CONFIDENCE_BASE + CONFIDENCE_SUPPORT * support), 4)


def gained(value: Column, depth: Column) -> Column:
    """Value times the contrast gain, which may overflow, but never to NaN."""
    return F.when(value == 0, 0.0).otherwise(value * F.pow(F.lit(CONTRAST_GAIN), depth))


def raw_score(codes: Column) -> Column:
    """Sum of the scoped weights over an array of token codes.

    The sum is kept relative to the gain of the current depth: a contrast word
    divides what came before.  It stays finite for any number of them.  ``scale`` is the
    product of the factors in scope, below zero behind a negator.  A code passes the
    conditions up to its own role only, and copies what it leaves alone.
    """

    def state(scale: Column, depth: Column, raw: Column) -> Column:
        return F.struct(scale.alias("scale"), depth.alias("depth"), raw.alias("raw"))

    def step(s: Column, code: Column) -> Column:
        scale, depth, raw = s["scale"], s["depth"], s["raw"]
        weight = clamp((code / F.lit(100.0)) * scale)
        factor = (code - FACTOR_BASE) / F.lit(100.0)
        return (
            F.when(code < FACTOR_BASE, state(scale, depth, raw + weight))
            .when(code == BREAK_CODE, state(F.lit(1.0), depth, raw))
            .when(code == NEGATOR_CODE, state(-F.abs(scale), depth, raw))
            .when(code == CONTRAST_CODE, state(F.lit(1.0), depth + 1, raw / CONTRAST_GAIN))
            .otherwise(state(scale * factor, depth, raw))
        )

    start = state(F.lit(1.0), F.lit(0), F.lit(0.0))
    return F.aggregate(codes, start, step, lambda s: gained(s["raw"], s["depth"]))


def with_scores(df: DataFrame, text: str = "text") -> DataFrame:
    """Add sentiment, score, raw_score, confidence, tokens, opinions,
    decisions and keywords for the text of each row."""
    hits, words, raw = F.col("_hits"), F.col("_words"), F.col("_raw")
    folded = raw_score(without_idle_breaks("_codes"))
    kept = [F.col(c) for c in df.columns]
    return (
        with_pieces(df, text, "_pieces")
        .withColumns({"_hits": scored("_pieces"), "tokens": F.size("_pieces")})
        .withColumns(
            {
                "_words": opinion_words("_hits"),
                "_codes": token_codes("_hits"),
                "decisions": F.size(hits),
            }
        )
        .withColumns(
            {
                "opinions": F.size(words),
                "keywords": F.slice(words, 1, MAX_KEYWORDS),
                "_raw": F.when(F.size(words) > 0, folded).otherwise(0.0),
            }
        )
        .withColumn("_squashed", squash(raw))
        .select(
            *kept,
            sentiment_class(F.col("_squashed")).alias("sentiment"),
            F.round("_squashed", 6).alias("score"),
            F.round(raw, 6).alias("raw_score"),
            confidence(raw, F.col("opinions")).alias("confidence"),
            "tokens",
            "opinions",
            "decisions",
            "keywords",
        )
    )


# --------------------------------------------------------------------------
# Detail behind a score
# --------------------------------------------------------------------------


def clause_array(tokens: str, scored_only: bool = False) -> Column:
    """Tokens cut into clauses: array of (clause, depth, items).

    ``clause`` counts the breaks before, ``depth`` the contrast words before.
    An item is ``position:token``; a break is the first item of the clause it
    opens; with ``scored_only`` other tokens are left out.  Two nested splits
    keep the cost linear in the length of the text (tokens hold neither ``|``,
    ``/`` nor ``:``).
    """
    kept = f"t {lx.in_list(lx.scored_tokens)}" if scored_only else "true"
    marked = F.expr(
        f"array_join(transform({tokens}, (t, i) -> CASE WHEN {kept} THEN concat("
        f"CASE WHEN t {lx.in_list(lx.contrasts)} THEN '|' "
        f"WHEN t {lx.in_list(lx.clause_breaks)} THEN '/' ELSE '' END, i, ':', t) END), ' ')"
    )

    def clauses_of(segment: Column, depth: Column) -> Column:
        return F.transform(
            F.split(segment, "/"),
            lambda part: F.struct(
                depth.alias("depth"),
                F.filter(F.split(part, " "), lambda i: i != "").alias("items"),
            ),
        )

    nested = F.flatten(F.transform(F.split(marked, r"\|"), clauses_of))
    return F.transform(
        nested,
        lambda c, index: F.struct(
            index.alias("clause"), c["depth"].alias("depth"), c["items"].alias("items")
        ),
    )


def clause_spans(tokens: str, breaks: str) -> Column:
    """Tokens cut into clauses: array of (clause, depth, start, found).

    ``breaks`` is the column of ``break_places``; ``start`` is the place of the first of the
    ``found`` tokens.  The depths come from one mark for each break, cut at the contrast
    words, so the cost is linear in the length of the text and no token is copied into text.
    """
    marks = F.array_join(
        F.transform(
            breaks, lambda i: F.when(lx.is_contrast(F.get(F.col(tokens), i)), "|").otherwise("/")
        ),
        "",
    )
    depths = F.flatten(
        F.transform(
            F.split(marks, r"\|"), lambda plain, depth: F.array_repeat(depth, F.length(plain) + 1)
        )
    )

    def span(depth: Column, clause: Column) -> Column:
        start = F.coalesce(F.get(F.col(breaks), clause - 1), F.lit(0))
        end = F.coalesce(F.get(F.col(breaks), clause), F.size(tokens))
        return F.struct(
            clause.alias("clause"), depth.alias("depth"), start.alias("start"),
            F.slice(tokens, start + 1, end - start).alias("found"),
        )

    return F.transform(depths, span)


def break_places(tokens: str) -> Column:
    """Places of the clause breaks in a token list."""
    return F.expr(
        f"filter(transform({tokens}, (t, i) -> CASE WHEN t {lx.in_list(lx.clause_breaks)} THEN i END), "
        "i -> i IS NOT NULL)"
    )


def item_position(item: Column) -> Column:
    return F.substring_index(item, ":", 1).cast("int")


def item_token(item: Column) -> Column:
    return F.substring_index(item, ":", -1)


def running_product(factors: Column, n: Column, blocks: Column) -> Column:
    """Product of the first n factors, from the products of whole blocks before."""
    block = F.floor(n / F.lit(BLOCK)).cast("int")
    rest = F.slice(factors, block * BLOCK + 1, n - block * BLOCK)
    return F.aggregate(rest, F.get(blocks, block), lambda total, f: total * f)


def block_products(factors: Column) -> Column:
    """Product of all factors before each block; one more than there are whole blocks."""
    products = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(factors) / F.lit(BLOCK)).cast("int")),
        lambda b: F.aggregate(
            F.slice(factors, b * BLOCK + 1, BLOCK), F.lit(1.0), lambda total, f: total * f
        ),
    )
    return F.aggregate(
        products,
        F.array(F.lit(1.0)),
        lambda done, p: F.concat(done, F.array(F.element_at(done, -1) * p)),
    )


def clause_opinions(items: Column) -> Column:
    """Opinions of one clause with the scope that reaches each of them.

    The clause is cut at its modifiers, so the number of a part is that of the modifiers
    before its opinions, whose product is taken from block products.  The cost is that
    of BLOCK factors for each opinion, however long the clause.
    """

    def is_modifier(item: Column) -> Column:
        return lx.modifier_factor(item_token(item)).isNotNull()

    cut = F.transform(
        items,
        lambda i: F.when(is_modifier(i), F.lit("|")).when(
            lx.opinion_weight(item_token(i)).isNotNull(), i
        ),
    )
    sorted_out = F.struct(
        F.transform(F.filter(items, is_modifier), lambda m: lx.modifier_factor(item_token(m))).alias(
            "factors"
        ),
        F.array_min(
            F.transform(F.filter(items, lambda i: lx.is_negator(item_token(i))), item_position)
        ).alias("negator"),
        F.split(F.array_join(cut, " "), r"\|").alias("parts"),
    )

    def scoped(clause: Column, item: Column, modifiers: Column) -> Column:
        return F.struct(
            item_position(item).alias("pos"),
            item_token(item).alias("token"),
            F.coalesce(item_position(item) > clause["negator"], F.lit(False)).alias("negated"),
            running_product(clause["factors"], modifiers, clause["blocks"]).alias("factor"),
        )

    def opinions_of(clause: Column) -> Column:
        return F.flatten(
            F.transform(
                clause["parts"],
                lambda part, k: F.transform(
                    F.filter(F.split(part, " "), lambda i: i != ""), lambda i: scoped(clause, i, k)
                ),
            )
        )

    def weighed(opinion: Column) -> Column:
        weight = lx.opinion_weight(opinion["token"]) * opinion["factor"]
        return F.struct(
            *[opinion[n].alias(n) for n in ("pos", "token", "negated", "factor")],
            weight.alias("weight"),
            clamp(F.when(opinion["negated"], -weight).otherwise(weight)).alias("signed_weight"),
        )

    blocked = F.transform(
        F.array(sorted_out),
        lambda c: F.struct(
            *[c[n].alias(n) for n in ("factors", "negator", "parts")],
            block_products(c["factors"]).alias("blocks"),
        ),
    )
    found = F.transform(blocked, opinions_of)
    return F.transform(F.get(found, F.lit(0)), weighed)


def with_clauses(df: DataFrame, text: str = "text", scored_only: bool = False) -> DataFrame:
    """One row per clause of each text: adds clause, depth and items."""
    return (
        with_tokens(df, text, "_tokens")
        .withColumn("_clause", F.explode(clause_array("_tokens", scored_only)))
        .withColumns({n: F.col("_clause")[n] for n in ("clause", "depth", "items")})
        .drop("_tokens", "_clause")
    )


def with_opinions(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per clause that holds an opinion, with the array ``found``."""
    holds_opinion = F.expr(
        f"exists(items, i -> substring_index(i, ':', -1) {lx.in_list(lx.active_opinions)})"
    )
    return (
        with_clauses(df, text, scored_only=True)
        .where(holds_opinion)
        .withColumn("found", clause_opinions(F.col("items")))
        .drop("items")
    )
