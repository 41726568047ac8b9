"""The scoring rules as SQL functions of the session.

``register`` creates them; they are SQL text alone and stay in the JVM.  Scalar functions
take a text: ``mention_score``, ``mention_sentiment``, ``mention_token_list``.  Table
functions give rows: ``mention_tokens`` (pos, token) and ``mention_opinions``
(strength_rank, pos, token, signed_weight), for use behind ``LATERAL``, which joins the
rows back by text; ``mention_token_list`` and ``mention_opinion_list`` in a subquery, with
LATERAL VIEW, move nothing.

Each function is a step on the result of another one, so Spark makes a projection of each
and computes it once for a row.  A null text has a null score and class, and no rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clamor.functions import accents
from clamor.functions import lexicon as lx
from clamor.functions import scoring as sc
from clamor.functions import text as tx


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _several() -> str:
    """Folding of one character ``c`` that becomes several."""
    _, _, several = accents.folding_tables()
    first, last = quoted(chr(accents.HANGUL_FIRST)), quoted(chr(accents.HANGUL_LAST))
    place = f"(ascii(c) - {accents.HANGUL_FIRST})"

    def jamo(start: int, size: int, index: str) -> str:
        return f"substring({quoted(''.join(chr(start + i) for i in range(size)))}, {index}, 1)"

    lead = jamo(0x1100, 19, f"CAST(floor({place} / 588) AS INT) + 1")
    vowel = jamo(0x1161, 21, f"CAST(floor(({place} % 588) / 28) AS INT) + 1")
    tail = jamo(0x11A8, 27, f"CAST({place} % 28 AS INT)")
    values = f"split({quoted(chr(10).join(several.values()))}, '\\n')"
    found = f"try_element_at({values}, nullif(instr({quoted(''.join(several))}, c), 0))"
    return (
        f"CASE WHEN c <= {quoted(chr(0x7F))} THEN c "
        f"WHEN c BETWEEN {first} AND {last} AND {place} % 28 > 0 THEN concat({lead}, {vowel}, {tail}) "
        f"WHEN c BETWEEN {first} AND {last} THEN concat({lead}, {vowel}) "
        f"ELSE coalesce({found}, c) END"
    )


def _functions() -> list[tuple[str, str, str, str]]:
    """(name, parameters, result, body) in the order of their use."""
    single, deleted, _ = accents.folding_tables()
    source, target = "".join(single) + deleted, "".join(single.values())
    url, user = quoted(tx.URL), quoted(tx.USER)
    joined = "array_join(found, ' ')"
    for phrase in lx.PHRASES:
        joined = f"replace({joined}, {quoted(phrase)}, ' {lx.CONTRAST_TOKEN} ')"
    item = "substring_index(i, ':', -1)"
    weights, factors = (lx.map_of(m, "double") for m in (lx.active_opinions, lx.active_modifiers))
    weight, factor = (f"try_element_at({m}, {item})" for m in (weights, factors))
    signed = (
        f"greatest(-1.0D, least(1.0D, CASE WHEN s.negated THEN -1.0D ELSE 1.0D END * {weight} * s.factor))"
    )
    text = "t STRING"
    return [
        (
            "mention_folded_rare", "d STRING", "STRING",
            f"CASE WHEN d RLIKE {quoted(accents.rare_class())} THEN array_join("
            f"transform(regexp_extract_all(d, '(?s).', 0), c -> {_several()}), '') ELSE d END",
        ),
        (
            "mention_folded", "l STRING", "STRING",
            "CASE WHEN octet_length(l) = length(l) THEN l ELSE translate(mention_folded_rare("
            f"replace(l, {quoted(chr(0x2026))}, '...')), {quoted(source)}, {quoted(target)}) END",
        ),
        (
            "mention_unlinked", "f STRING", "STRING",
            "CASE WHEN contains(f, 'http') OR contains(f, 'www.') OR contains(f, '@') THEN "
            f"regexp_replace(regexp_replace(f, {url}, ' '), {user}, ' ') ELSE f END",
        ),
        (
            "mention_collapsed", "found ARRAY<STRING>, clean STRING", "ARRAY<STRING>",
            f"CASE WHEN {tx.may_collapse_sql('clean')} THEN split({joined}, ' ') ELSE found END",
        ),
        (
            "mention_found", "clean STRING", "ARRAY<STRING>",
            f"mention_collapsed(regexp_extract_all(clean, {quoted(tx.PIECES)}, 0), clean)",
        ),
        (
            "mention_pieces", text, "ARRAY<STRING>",
            tx.meaningful_sql("mention_found(mention_unlinked(mention_folded(lower(t))))"),
        ),
        ("mention_token_list", text, "ARRAY<STRING>", tx.tokens_sql("mention_pieces(t)")),
        (
            "mention_raw", "codes ARRAY<INT>", "DOUBLE",
            f"""aggregate(codes,
              named_struct('negated', false, 'factor', 1.0D, 'depth', 0, 'raw', 0.0D),
              (s, c) -> named_struct(
                'negated', CASE WHEN c >= {sc.BREAK_CODE} THEN false
                  ELSE s.negated OR c = {sc.NEGATOR_CODE} END,
                'factor', CASE WHEN c >= {sc.BREAK_CODE} THEN 1.0D
                  WHEN c BETWEEN {sc.FACTOR_BASE} AND {sc.NEGATOR_CODE - 1}
                  THEN s.factor * ((c - {sc.FACTOR_BASE}) / 100.0D) ELSE s.factor END,
                'depth', CASE WHEN c = {sc.CONTRAST_CODE} THEN s.depth + 1 ELSE s.depth END,
                'raw', CASE WHEN c = {sc.CONTRAST_CODE} THEN s.raw / {sc.CONTRAST_GAIN}D
                  WHEN c < {sc.FACTOR_BASE} THEN s.raw + greatest(-1.0D, least(1.0D,
                    CASE WHEN s.negated THEN -1.0D ELSE 1.0D END * (c / 100.0D) * s.factor))
                  ELSE s.raw END),
              s -> CASE WHEN s.raw = 0 THEN 0.0D
                ELSE s.raw * power({sc.CONTRAST_GAIN}D, s.depth) END)""",
        ),
        (
            "mention_squashed", text, "DOUBLE",
            f"tanh(mention_raw({sc.token_codes_sql(sc.scored_sql('mention_pieces(t)'))})"
            f" / {sc.SCORE_SCALE}D)",
        ),
        ("mention_score", text, "DOUBLE", "round(mention_squashed(t), 6)"),
        (
            "mention_class", "s DOUBLE", "STRING",
            f"CASE WHEN s > {sc.NEUTRAL_BAND}D THEN '{sc.POSITIVE}' "
            f"WHEN s < -{sc.NEUTRAL_BAND}D THEN '{sc.NEGATIVE}' "
            f"WHEN s IS NOT NULL THEN '{sc.NEUTRAL}' END",
        ),
        ("mention_sentiment", text, "STRING", "mention_class(mention_squashed(t))"),
        (
            # Scored tokens as "position:token", cut at the breaks; each clause is folded apart.
            "mention_clauses", "tokens ARRAY<STRING>", "ARRAY<STRING>",
            f"""split(array_join(transform(tokens, (x, i) -> CASE
              WHEN x {lx.in_list(lx.clause_breaks | lx.contrasts)} THEN '|'
              WHEN x {lx.in_list(lx.scored_tokens)} THEN concat(i, ':', x) END), ' '), '\\\\|')""",
        ),
        (
            "mention_opinion_list", text,
            "ARRAY<STRUCT<strength: DOUBLE, pos: INT, token: STRING, signed_weight: DOUBLE>>",
            f"""array_sort(flatten(transform(mention_clauses(mention_token_list(t)), part ->
              aggregate(filter(split(part, ' '), i -> i <> ''),
                named_struct('negated', false, 'factor', 1.0D, 'found', CAST(array() AS
                  ARRAY<STRUCT<strength: DOUBLE, pos: INT, token: STRING, signed_weight: DOUBLE>>)),
                (s, i) -> named_struct(
                  'negated', s.negated OR {item} {lx.in_list(lx.negators)},
                  'factor', s.factor * coalesce({factor}, 1.0D),
                  'found', CASE WHEN {weight} IS NULL THEN s.found ELSE concat(s.found, array(
                    named_struct('strength', -abs({signed}),
                      'pos', CAST(substring_index(i, ':', 1) AS INT),
                      'token', {item}, 'signed_weight', {signed}))) END),
                s -> s.found))))""",
        ),
    ]


# The outer form keeps Spark from testing the size of a list before it is built.
TABLES = [
    (
        "mention_tokens", "TABLE(pos INT, token STRING)",
        "SELECT pos, token FROM (SELECT mention_token_list(t) AS list) "
        "LATERAL VIEW OUTER posexplode(list) x AS pos, token WHERE token IS NOT NULL",
    ),
    (
        "mention_opinions",
        "TABLE(strength_rank INT, pos INT, token STRING, signed_weight DOUBLE)",
        "SELECT place + 1, o.pos, o.token, round(o.signed_weight, 6) "
        "FROM (SELECT mention_opinion_list(t) AS list) "
        "LATERAL VIEW OUTER posexplode(list) x AS place, o WHERE o IS NOT NULL",
    ),
]


def register(spark: SparkSession) -> None:
    """Create the functions in this session."""
    create = "CREATE OR REPLACE TEMPORARY FUNCTION"
    for name, parameters, result, body in _functions():
        spark.sql(f"{create} {name}({parameters}) RETURNS {result} RETURN {body}")
    for name, result, body in TABLES:
        spark.sql(f"{create} {name}(t STRING) RETURNS {result} RETURN {body}")
