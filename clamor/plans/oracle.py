"""The same queries as DuckDB SQL, written with joins and window functions."""

from __future__ import annotations

from clamor.functions import lexicon as lx
from clamor.plans.fixtures import PHRASES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in sorted(values))


PHRASE_ROWS = ",\n".join(
    f"({i}, {_text(text)}, '{label}')" for i, (text, label) in enumerate(PHRASES)
)


def _lexicon_rows() -> str:
    rows = []
    for token in sorted(lx.scored_tokens):
        if token in lx.contrasts:
            kind, value = "contrast", 0.0
        elif token in lx.clause_breaks:
            kind, value = "break", 0.0
        elif token in lx.negators:
            kind, value = "negator", -1.0
        elif token in lx.modifier_factors:
            kind, value = "modifier", lx.modifier_factors[token]
        else:
            kind, value = "opinion", lx.polarity_weights[token]
        rows.append(f"({_text(token)}, '{kind}', CAST({value} AS DOUBLE))")
    return ",\n".join(rows)


MENTIONS = f"""
phrases(pid, text, label) AS (VALUES {PHRASE_ROWS}),
mentions AS (
  SELECT 'm' || event_id AS mention_id, event_id AS n, ts,
         ['acme', 'globex', 'initech'][event_id % 3 + 1] AS brand,
         CASE event_id % 4 WHEN 1 THEN '' WHEN 2 THEN 'feed_a' WHEN 3 THEN 'feed_b' END AS source,
         event_type AS platform, 'user_' || user_id AS author,
         CAST(user_id * 37 % 9000 AS INTEGER) AS author_followers, p.text,
         CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'en' ELSE 'es' END AS lang,
         CASE event_id % 4 WHEN 1 THEN ['launch'] WHEN 2 THEN ['launch', 'review']
                           WHEN 3 THEN ['review', 'review'] END AS hashtags,
         CAST(event_id % 50 AS INTEGER) AS likes, CAST(event_id % 7 AS INTEGER) AS shares,
         CASE WHEN event_id % 7 <> 3 THEN p.label END AS expected,
         event_id // 1000 AS batch_id
  FROM events JOIN phrases p ON p.pid = event_id % 20
),
raw_mentions AS (
  SELECT CASE WHEN n % 83 <> 0 THEN mention_id END AS mention_id, n, platform,
         CASE WHEN n % 97 <> 0 THEN author END AS author,
         CASE WHEN n % 89 <> 0 THEN text END AS text, batch_id
  FROM mentions
  JOIN (SELECT unnest([0, 1]) AS copy) ON copy = 0 OR n % 50 = 0
)"""

DOCUMENT_TEXTS = """
src AS (
  SELECT 'd' || doc_id AS mention_id, coalesce(d.text || ' ', '') || p.text AS text
  FROM documents d JOIN phrases p ON p.pid = doc_id % 20
)"""
TURN_TEXTS = """
src AS (
  SELECT 'c' || conv_id || '_' || turn AS mention_id, coalesce(c.text || ' ', '') || p.text AS text
  FROM conversations c JOIN phrases p ON p.pid = (conv_id + turn) % 20
)"""
MENTION_TEXTS = "src AS (SELECT mention_id, text FROM mentions)"
PAGE_TEXTS = "src AS (SELECT page_id AS mention_id, html AS text FROM pages)"

FOLD = "strip_accents(replace(lower(text), '…', '...'))"

NORMAL = rf"""
folded AS (SELECT mention_id, {FOLD} AS t FROM src),
linkless AS (
  SELECT mention_id, regexp_replace(regexp_replace(t, 'https?://\S+|www\.\S+', ' ', 'g'),
                                    '@[\p{{L}}\p{{N}}_]+', ' ', 'g') AS t FROM folded
),
marked AS (
  SELECT mention_id, regexp_replace(regexp_replace(t, '\.\.\.|[.!?;:]+', ' __pausa__ ', 'g'),
                                    ',+', ' __coma__ ', 'g') AS t FROM linkless
),
normal AS (
  SELECT mention_id,
         trim(regexp_replace(regexp_replace(t, '[^a-z0-9#''_ ]+', ' ', 'g'), ' +', ' ', 'g'))
           AS normalized
  FROM marked
),
collapsed AS (
  SELECT mention_id,
         replace(replace(replace(replace(replace(normalized,
           'sin embargo', ' contrastomarcador '), 'no obstante', ' contrastomarcador '),
           'that said', ' contrastomarcador '), 'dicho esto', ' contrastomarcador '),
           'en resumen', ' contrastomarcador ') AS collapsed
  FROM normal
)"""

TOKENS = f"""{NORMAL},
words AS (
  SELECT mention_id, unnest(string_split(collapsed, ' ')) AS token,
         generate_subscripts(string_split(collapsed, ' '), 1) AS i
  FROM collapsed
),
tokens AS (
  SELECT mention_id, token,
         CAST(row_number() OVER (PARTITION BY mention_id ORDER BY i) - 1 AS INTEGER) AS pos
  FROM words
  WHERE length(token) > 1 AND token NOT IN ({_list(lx.stopwords)})
),
lexicon(token, kind, value) AS (VALUES {_lexicon_rows()}),
tagged AS (
  SELECT t.mention_id, t.pos, t.token, l.kind, l.value FROM tokens t LEFT JOIN lexicon l USING (token)
)"""

OPINIONS = f"""{TOKENS},
placed AS (
  SELECT *,
         sum(CASE WHEN kind IN ('break', 'contrast') THEN 1 ELSE 0 END) OVER w AS clause,
         sum(CASE WHEN kind = 'contrast' THEN 1 ELSE 0 END) OVER w AS depth
  FROM tagged WINDOW w AS (PARTITION BY mention_id ORDER BY pos)
),
scoped AS (
  SELECT *,
         coalesce(max(CASE WHEN kind = 'negator' THEN 1 ELSE 0 END) OVER w, 0) = 1 AS negated,
         coalesce(product(CASE WHEN kind = 'modifier' THEN value ELSE 1.0 END) OVER w, 1.0) AS factor
  FROM placed
  WINDOW w AS (PARTITION BY mention_id, clause ORDER BY pos
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
opinions AS (
  SELECT mention_id, CAST(clause AS INTEGER) AS clause, CAST(depth AS INTEGER) AS depth, pos, token,
         negated, factor, value * factor AS weight,
         greatest(-1.0, least(1.0, CASE WHEN negated THEN -value * factor ELSE value * factor END))
           AS signed_weight
  FROM scoped WHERE kind = 'opinion'
)"""

SCORES = f"""{OPINIONS},
raws AS (
  SELECT mention_id, sum(signed_weight * pow(1.9, depth)) AS raw, count(*) AS n_opinions,
         list(token ORDER BY pos) AS said
  FROM opinions GROUP BY mention_id
),
sizes AS (
  SELECT mention_id, count(*) AS n_tokens, count(kind) AS n_decisions FROM tagged GROUP BY mention_id
),
squashed AS (
  SELECT s.mention_id, coalesce(raw, 0.0) AS raw, tanh(coalesce(raw, 0.0) / 1.9) AS squashed,
         CAST(coalesce(n_opinions, 0) AS INTEGER) AS opinions,
         CAST(coalesce(n_tokens, 0) AS INTEGER) AS tokens,
         CAST(coalesce(n_decisions, 0) AS INTEGER) AS decisions, coalesce(said, []) AS said
  FROM src s LEFT JOIN raws USING (mention_id) LEFT JOIN sizes USING (mention_id)
),
scores AS (
  SELECT mention_id,
         CASE WHEN squashed > 0.06 THEN 'POSITIVO' WHEN squashed < -0.06 THEN 'NEGATIVO'
              ELSE 'NEUTRAL' END AS sentiment,
         round(squashed, 6) AS score, round(raw, 6) AS raw_score,
         round(least(1.0, abs(raw) / 2.2) * (0.6 + 0.4 * least(1.0, opinions / 3.0)), 4) AS confidence,
         tokens, opinions, decisions, said[1:4] AS keywords
  FROM squashed
)"""

FACTS = f"""{MENTIONS}, {MENTION_TEXTS}, {SCORES},
facts AS (
  SELECT m.mention_id, ts, brand, coalesce(nullif(source, ''), 'desconocida') AS source, platform,
         author, author_followers, text, coalesce(lang, 'es') AS lang,
         coalesce(hashtags, []) AS hashtags, keywords, sentiment, score, confidence, tokens,
         opinions, decisions, expected, likes, shares, batch_id, n
  FROM mentions m JOIN scores USING (mention_id)
),
stats AS (
  SELECT batch_id, max(ts) AS processed_at, count(*) AS messages,
         CAST(sum(tokens) AS BIGINT) AS total_tokens, CAST(sum(decisions) AS BIGINT) AS decisions,
         CAST(sum(opinions) AS BIGINT) AS opinions,
         CAST(sum(CASE WHEN tokens > 1 THEN ceil(tokens * log2(tokens) - tokens + 1) ELSE 0 END)
              AS BIGINT) AS bound,
         CAST(max(tokens) AS BIGINT) AS max_tokens,
         count(*) FILTER (WHERE expected = sentiment) AS correct,
         count(*) FILTER (WHERE sentiment = 'POSITIVO') AS positive,
         count(*) FILTER (WHERE sentiment = 'NEUTRAL') AS neutral,
         count(*) FILTER (WHERE sentiment = 'NEGATIVO') AS negative
  FROM facts GROUP BY batch_id
)"""

CLEAN_FACTS = f"""{FACTS},
clean_facts AS (
  SELECT f.* FROM facts f
  WHERE n % 83 <> 0 AND n % 89 <> 0 AND n % 97 <> 0
)"""


def _graph(facts: str) -> str:
    return f"""
parts AS (
  SELECT mention_id, batch_id, sentiment, score, author, brand, platform, 'fact' AS part,
         NULL AS entity FROM {facts}
  UNION ALL
  SELECT mention_id, batch_id, sentiment, score, author, brand, platform, 'tag', unnest(hashtags)
  FROM {facts}
  UNION ALL
  SELECT mention_id, batch_id, sentiment, score, author, brand, platform, 'word', unnest(keywords)
  FROM {facts}
),
named AS (
  SELECT *, 'USUARIO:' || author AS user_node, 'MARCA:' || brand AS brand_node,
         'PLATAFORMA:' || platform AS place_node,
         CASE part WHEN 'tag' THEN 'HASHTAG:' WHEN 'word' THEN 'PALABRA:' END || entity AS own_node
  FROM parts
),
node_kinds(part, label) AS (
  VALUES ('fact', 'MARCA'), ('fact', 'USUARIO'), ('fact', 'PLATAFORMA'), ('tag', 'HASHTAG'),
         ('word', 'PALABRA')
),
relations(part, rel) AS (
  VALUES ('fact', 'MENCIONA'), ('fact', 'PUBLICA'), ('fact', 'EN_PLATAFORMA'), ('tag', 'ETIQUETA'),
         ('tag', 'CON_HASHTAG'), ('word', 'APARECE_EN'), ('word', 'USA')
),
node_rows AS (
  SELECT mention_id, batch_id, sentiment, score, label,
         CASE label WHEN 'MARCA' THEN brand WHEN 'USUARIO' THEN author
                    WHEN 'PLATAFORMA' THEN platform ELSE entity END AS name
  FROM named JOIN node_kinds ON node_kinds.part = named.part
),
edge_rows AS (
  SELECT mention_id, batch_id, sentiment, score, rel,
         CASE WHEN rel IN ('MENCIONA', 'PUBLICA', 'ETIQUETA') THEN user_node
              WHEN rel IN ('EN_PLATAFORMA', 'CON_HASHTAG') THEN brand_node ELSE own_node END AS src,
         CASE WHEN rel IN ('MENCIONA', 'APARECE_EN') THEN brand_node
              WHEN rel IN ('PUBLICA', 'EN_PLATAFORMA') THEN place_node
              WHEN rel = 'USA' THEN user_node ELSE own_node END AS dst
  FROM named JOIN relations ON relations.part = named.part
),
nodes AS (
  SELECT label || ':' || name AS node_id, label, name, count(*) AS weight,
         count(*) FILTER (WHERE sentiment = 'POSITIVO') AS pos,
         count(*) FILTER (WHERE sentiment = 'NEUTRAL') AS neu,
         count(*) FILTER (WHERE sentiment = 'NEGATIVO') AS neg,
         round(sum(score), 6) AS score_sum
  FROM node_rows GROUP BY label, name
),
edges AS (
  SELECT src, dst, rel, count(*) AS weight, round(sum(score), 6) AS score_sum
  FROM edge_rows GROUP BY src, dst, rel
),
nodes_s AS (
  SELECT *, CASE WHEN score_sum / weight > 0.06 THEN 'POSITIVO'
                 WHEN score_sum / weight < -0.06 THEN 'NEGATIVO' ELSE 'NEUTRAL' END AS sentiment
  FROM nodes
),
edges_s AS (
  SELECT *, CASE WHEN score_sum / weight > 0.06 THEN 'POSITIVO'
                 WHEN score_sum / weight < -0.06 THEN 'NEGATIVO' ELSE 'NEUTRAL' END AS sentiment
  FROM edges
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label
              ORDER BY weight DESC, abs(score_sum / weight) DESC, node_id) AS rn
  FROM nodes_s
)"""


GRAPH = f"{FACTS}, {_graph('facts')}"
CLEAN_GRAPH = f"{CLEAN_FACTS}, {_graph('clean_facts')}"

NULL_GRAPH = f"""{FACTS},
null_facts AS (
  SELECT * REPLACE (CASE WHEN n % 4 = 1 THEN [] ELSE hashtags END AS hashtags,
                    CASE WHEN n % 3 = 0 THEN [] ELSE keywords END AS keywords)
  FROM facts
), {_graph('null_facts')}"""

SLICE = f"""{GRAPH},
slice AS (
  SELECT node_id, label, name, weight, pos, neu, neg, score_sum, sentiment FROM nodes_s
  ORDER BY label = 'MARCA' DESC, weight DESC, node_id LIMIT 140
)"""

VISIBLE = f"""{GRAPH},
others AS (
  SELECT *, row_number() OVER (ORDER BY weight DESC, node_id) AS place FROM nodes_s
  WHERE label IN ('PLATAFORMA', 'HASHTAG', 'PALABRA')
),
shown AS (
  SELECT node_id, label, name, weight, score_sum, sentiment FROM nodes_s WHERE label = 'MARCA'
  UNION ALL
  SELECT node_id, label, name, weight, score_sum, sentiment FROM others
  WHERE place <= 30 - (SELECT count(*) FROM nodes_s WHERE label = 'MARCA')
)"""

SESSION = f"""{FACTS},
touches AS (
  SELECT ts, mention_id, sentiment, 0 AS touch, 'MARCA' AS src, '' AS dst, '' AS rel, 'Marca' AS name FROM facts
  UNION ALL SELECT ts, mention_id, sentiment, 1, 'USUARIO:' || author, '', '', author FROM facts
  UNION ALL SELECT ts, mention_id, sentiment, 2, 'USUARIO:' || author, 'MARCA', 'MENCIONA', '' FROM facts
  UNION ALL SELECT ts, mention_id, sentiment, 3, 'PLATAFORMA:' || platform, '', '', platform FROM facts
  UNION ALL SELECT ts, mention_id, sentiment, 4, 'USUARIO:' || author, 'PLATAFORMA:' || platform, 'PUBLICA', '' FROM facts
  UNION ALL SELECT ts, mention_id, sentiment, 5, 'MARCA', 'PLATAFORMA:' || platform, 'EN_PLATAFORMA', '' FROM facts
  UNION ALL SELECT ts, mention_id, sentiment, 4 + 2 * generate_subscripts(keywords, 1), 'PALABRA:' || unnest(keywords), '', '', unnest(keywords) FROM facts
  UNION ALL SELECT ts, mention_id, sentiment, 5 + 2 * generate_subscripts(keywords, 1), 'PALABRA:' || unnest(keywords), 'MARCA', 'APARECE_EN', '' FROM facts
),
session AS (
  SELECT src, dst, rel, name, count(*) AS weight,
         count(*) FILTER (WHERE sentiment = 'POSITIVO') AS pos,
         count(*) FILTER (WHERE sentiment = 'NEUTRAL') AS neu,
         count(*) FILTER (WHERE sentiment = 'NEGATIVO') AS neg,
         max(struct_pack(ts := ts, mention_id := mention_id, touch := touch)) AS last_touch
  FROM touches GROUP BY src, dst, rel, name
),
classed AS (
  SELECT *, CASE WHEN pos >= neu AND pos >= neg THEN 'POSITIVO' WHEN neg >= neu THEN 'NEGATIVO'
                 ELSE 'NEUTRAL' END AS sentiment
  FROM session
)"""

BUCKETS = f"""{FACTS},
buckets AS (
  SELECT CAST(date_trunc('minute', ts) AS VARCHAR) AS bucket, sentiment, count(*) AS mentions
  FROM facts
  WHERE ts >= (SELECT date_trunc('minute', max(ts)) FROM events) - INTERVAL 1440 MINUTE
  GROUP BY 1, 2
)"""

KPIS = f"""{FACTS},
kpis AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE sentiment = 'POSITIVO') AS positive,
         count(*) FILTER (WHERE sentiment = 'NEUTRAL') AS neutral,
         count(*) FILTER (WHERE sentiment = 'NEGATIVO') AS negative,
         count(expected) AS labelled,
         count(*) FILTER (WHERE expected = sentiment) AS correct,
         round(avg(score), 4) AS avg_score, round(avg(confidence), 4) AS avg_confidence,
         round(avg(decisions), 1) AS avg_decisions,
         count(DISTINCT author) AS authors, count(DISTINCT platform) AS platforms
  FROM facts
)"""

# A time as Spark writes it: no trailing zeros in the fraction.
TS = "regexp_replace(regexp_replace(strftime({0}, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '')"
JOINED = "array_to_string({0}, ',') AS {0}"
SCORE_LIST = (
    "mention_id, sentiment, score, raw_score, confidence, tokens, opinions, decisions, "
    + JOINED.format("keywords")
)
CLEAN_BUCKETS = (
    "SELECT CAST(date_trunc('minute', ts) AS VARCHAR) AS bucket, sentiment, "
    "count(*) AS mentions FROM clean_facts GROUP BY 1, 2"
)
STORED = (
    f"mention_id, {TS.format('ts')} AS ts, brand, source, platform, author, author_followers, "
    f"text, lang, {JOINED.format('hashtags')}, {JOINED.format('keywords')}, sentiment, score, "
    "confidence, tokens, opinions, decisions, expected, likes, shares"
)
SESSION_LIST = "src, dst, rel, name, weight, pos, neu, neg, sentiment"
STATS_LIST = (
    "batch_id, messages, total_tokens, decisions, opinions, bound, max_tokens, correct, positive, "
    "neutral, negative"
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _over(src: str, ctes: str, select: str) -> str:
    return _with(f"{MENTIONS}, {src}, {ctes}", select)


def _capped(session: str) -> str:
    return _with(
        f"""{session},
        kept AS (
          SELECT src FROM classed WHERE dst = '' AND src = 'MARCA'
          UNION ALL
          (SELECT src FROM classed WHERE dst = '' AND src <> 'MARCA' ORDER BY last_touch DESC, src LIMIT 59)
        )""",
        f"""SELECT {SESSION_LIST} FROM classed WHERE src IN (SELECT src FROM kept)
        AND (dst = '' OR dst IN (SELECT src FROM kept))""",
    )


ORACLE: dict[str, str] = {
    # A
    "json_decode": _with(
        MENTIONS,
        f"""SELECT mention_id, {TS.format("ts")} AS ts, brand, source,
        author, platform, text, lang, array_to_string(hashtags, ',') AS hashtags,
        author_followers, CASE WHEN n % 43 = 0 THEN -1 ELSE likes END AS likes, shares, expected
        FROM mentions WHERE n % 41 <> 0""",
    ),
    "json_encode": _with(
        MENTIONS,
        """SELECT mention_id AS key, '{"mention_id":"' || mention_id || '","ts":"'
        || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","brand":"' || brand || '"'
        || coalesce(',"source":"' || source || '"', '')
        || ',"author":"' || author || '","platform":"' || platform || '","text":"' || text || '"'
        || coalesce(',"lang":"' || lang || '"', '')
        || coalesce(',"hashtags":["' || array_to_string(hashtags, '","') || '"]', '')
        || ',"author_followers":' || author_followers || ',"likes":' || likes
        || ',"shares":' || shares || coalesce(',"expected":"' || expected || '"', '') || '}' AS value
        FROM mentions""",
    ),
    "valid_rows": _with(
        MENTIONS,
        """SELECT mention_id, author, text FROM raw_mentions
        WHERE mention_id IS NOT NULL AND text IS NOT NULL""",
    ),
    "apply_defaults": _with(
        MENTIONS,
        """SELECT mention_id, coalesce(nullif(source, ''), 'desconocida') AS source,
        coalesce(lang, 'es') AS lang, coalesce(array_to_string(hashtags, ','), '') AS hashtags,
        author_followers, likes, shares FROM mentions""",
    ),
    "rejects": _with(
        MENTIONS,
        """SELECT reason, batch_id, count(*) AS rows FROM (
          SELECT batch_id, CASE WHEN mention_id IS NULL THEN 'mention_id missing'
                      WHEN text IS NULL THEN 'text missing'
                      WHEN author IS NULL THEN 'author missing' END AS reason FROM raw_mentions)
        WHERE reason IS NOT NULL GROUP BY reason, batch_id""",
    ),
    "dedup_mentions": _with(
        MENTIONS,
        """SELECT DISTINCT mention_id, author, text, batch_id FROM raw_mentions r
        WHERE mention_id IS NOT NULL AND text IS NOT NULL AND author IS NOT NULL
          AND batch_id % 2 <> 0""",
    ),
    "batch_stats": _with(FACTS, f"SELECT {STATS_LIST}, 'acme' AS brand FROM stats"),
    "pipeline_state": _with(
        FACTS,
        f"""SELECT 'acme' AS brand, max(batch_id) AS last_batch,
        {TS.format('max(processed_at)')} AS last_updated FROM stats""",
    ),
    "union_sources": _with(
        MENTIONS,
        """SELECT mention_id, CASE WHEN platform = 'view' THEN 'feed_x' ELSE 'feed_y' END AS source,
        platform FROM mentions""",
    ),
    # B
    "strip_accents": "SELECT doc_id, md5(strip_accents(text)) AS folded_md5 FROM documents",
    "normalize_text": _over(
        DOCUMENT_TEXTS, NORMAL, "SELECT mention_id, md5(normalized) AS normal_md5 FROM normal"
    ),
    "normalize_pages": _with(
        f"{PAGE_TEXTS}, {NORMAL}",
        "SELECT mention_id AS page_id, md5(normalized) AS normal_md5 FROM normal",
    ),
    "collapse_phrases": _over(
        DOCUMENT_TEXTS, NORMAL, "SELECT mention_id, md5(collapsed) AS collapsed_md5 FROM collapsed"
    ),
    "tokenize": _over(
        DOCUMENT_TEXTS,
        TOKENS,
        """SELECT mention_id, CAST(count(t.token) AS INTEGER) AS tokens,
        md5(coalesce(string_agg(t.token, ' ' ORDER BY t.pos), '')) AS tokens_md5
        FROM src LEFT JOIN tokens t USING (mention_id) GROUP BY mention_id""",
    ),
    "extract_hashtags": r"""
        WITH found AS (
          SELECT page_id, unnest(f) AS tag, generate_subscripts(f, 1) AS i
          FROM (SELECT page_id,
                  regexp_extract_all(lower(html), '[@#]([\p{L}\p{N}_][\p{L}\p{N}_.-]*)', 1) AS f FROM pages)
        ),
        cleaned AS (
          SELECT page_id, regexp_replace(tag, '[^a-z0-9_#]', '', 'g') AS tag, min(i) AS i
          FROM found GROUP BY 1, 2
        )
        SELECT p.page_id, coalesce(string_agg(c.tag, ',' ORDER BY c.i), '') AS tags
        FROM pages p LEFT JOIN cleaned c ON c.page_id = p.page_id AND c.tag <> ''
        GROUP BY p.page_id""",
    "token_lexicon": _over(
        DOCUMENT_TEXTS,
        TOKENS,
        "SELECT mention_id, pos, token, kind, value FROM tagged WHERE kind IS NOT NULL",
    ),
    "token_stats": _over(
        DOCUMENT_TEXTS,
        SCORES,
        """SELECT mention_id, tokens, decisions, opinions,
        CAST(CASE WHEN tokens > 1 THEN ceil(tokens * log2(tokens) - tokens + 1) ELSE 0 END AS BIGINT)
        AS bound FROM scores""",
    ),
    # C
    "clauses": _over(
        DOCUMENT_TEXTS,
        OPINIONS,
        """SELECT mention_id, pos, token, CAST(clause AS INTEGER) AS clause,
        CAST(depth AS INTEGER) AS depth FROM placed""",
    ),
    "negation_scope": _over(
        TURN_TEXTS, OPINIONS, "SELECT mention_id, pos, token, clause, negated FROM opinions"
    ),
    "intensity_scope": _over(
        TURN_TEXTS,
        OPINIONS,
        "SELECT mention_id, pos, token, clause, round(factor, 6) AS factor FROM opinions",
    ),
    "opinions": _over(
        DOCUMENT_TEXTS,
        OPINIONS,
        """SELECT mention_id, clause, depth, pos, token, negated, round(factor, 6) AS factor,
        round(weight, 6) AS weight, round(signed_weight, 6) AS signed_weight FROM opinions""",
    ),
    "clause_breakdown": _over(
        DOCUMENT_TEXTS,
        OPINIONS,
        """SELECT mention_id, clause, string_agg(token, ' ' ORDER BY pos) AS tokens,
        round(sum(signed_weight), 4) AS weight,
        first(token ORDER BY abs(signed_weight) DESC, pos) AS dominant,
        round(first(signed_weight ORDER BY abs(signed_weight) DESC, pos), 4) AS dominant_weight,
        round(pow(1.9, max(depth)), 4) AS gain,
        round(sum(signed_weight) * pow(1.9, max(depth)), 4) AS weighted,
        max(depth) > 0 AS is_contrast, bool_or(negated) AS is_negated
        FROM opinions GROUP BY mention_id, clause""",
    ),
    "raw_score": _over(DOCUMENT_TEXTS, SCORES, "SELECT mention_id, raw_score FROM scores"),
    "score_class": _over(TURN_TEXTS, SCORES, "SELECT mention_id, score, sentiment FROM scores"),
    "confidence": _over(TURN_TEXTS, SCORES, "SELECT mention_id, confidence FROM scores"),
    "keywords": _over(
        MENTION_TEXTS, SCORES, f"SELECT mention_id, {JOINED.format('keywords')} FROM scores"
    ),
    "score_mentions": _over(MENTION_TEXTS, SCORES, f"SELECT {SCORE_LIST} FROM scores"),
    "score_documents": _over(DOCUMENT_TEXTS, SCORES, f"SELECT {SCORE_LIST} FROM scores"),
    "opinions_ranked": _over(
        MENTION_TEXTS,
        OPINIONS,
        """SELECT mention_id, CAST(row_number() OVER (PARTITION BY mention_id
             ORDER BY abs(signed_weight) DESC, pos) AS INTEGER) AS strength_rank,
        pos, token, round(signed_weight, 6) AS signed_weight FROM opinions""",
    ),
    "sql_scores": _over(MENTION_TEXTS, SCORES, "SELECT mention_id, sentiment, score FROM scores"),
    "correct_flag": _with(
        FACTS, "SELECT mention_id, CAST(expected = sentiment AS VARCHAR) AS correct FROM facts"
    ),
    "mention_facts": _with(
        FACTS,
        f"""SELECT mention_id, {TS.format('ts')} AS ts, brand, source, platform, author,
        author_followers, text, lang, {JOINED.format('hashtags')}, {JOINED.format('keywords')},
        sentiment, score, confidence, tokens, opinions, decisions, expected, likes, shares
        FROM facts""",
    ),
    # D
    "node_contrib": _with(
        GRAPH,
        """SELECT mention_id, sentiment, score, label || ':' || name AS node_id, label, name
        FROM node_rows""",
    ),
    "edge_contrib": _with(
        GRAPH, "SELECT mention_id, sentiment, score, src, dst, rel FROM edge_rows"
    ),
    "edge_contrib_join": _with(GRAPH, "SELECT src, dst, rel, sentiment, score FROM edge_rows"),
    "graph_nodes": _with(GRAPH, "SELECT * FROM nodes"),
    "graph_nodes_null_lists": _with(NULL_GRAPH, "SELECT * FROM nodes"),
    "graph_edges_null_lists": _with(NULL_GRAPH, "SELECT * FROM edges"),
    "graph_elements_null_lists": _with(
        NULL_GRAPH,
        """SELECT node_id AS element, weight FROM nodes_s
        UNION ALL SELECT src || '->' || dst || ':' || rel, weight FROM edges_s""",
    ),
    "edge_contrib_join_null_lists": _with(
        NULL_GRAPH, "SELECT src, dst, rel, sentiment, score FROM edge_rows"
    ),
    "graph_edges": _with(GRAPH, "SELECT * FROM edges"),
    "graph_sentiment": _with(
        GRAPH,
        """SELECT node_id AS element, weight, sentiment FROM nodes_s
        UNION ALL SELECT src || '->' || dst || ':' || rel, weight, sentiment FROM edges_s""",
    ),
    "graph_top_nodes": _with(
        GRAPH,
        "SELECT * EXCLUDE (rn) FROM ranked WHERE label IN ('MARCA', 'PLATAFORMA') OR rn <= 90",
    ),
    "graph_kept_edges": _with(
        f"""{GRAPH},
        kept AS (SELECT node_id FROM ranked WHERE label IN ('MARCA', 'PLATAFORMA') OR rn <= 20)""",
        """SELECT * FROM edges_s WHERE src IN (SELECT node_id FROM kept)
        AND dst IN (SELECT node_id FROM kept)""",
    ),
    "graph_increment": _with(GRAPH, "SELECT * FROM nodes"),
    "graph_slice_nodes": _with(SLICE, "SELECT * FROM slice"),
    "graph_slice_edges": _with(
        SLICE,
        """SELECT *, src || '->' || dst || ':' || rel AS edge_id FROM edges_s
        WHERE src IN (SELECT node_id FROM slice) AND dst IN (SELECT node_id FROM slice)""",
    ),
    "graph_label_counts": _with(GRAPH, "SELECT label, count(*) AS nodes FROM nodes GROUP BY label"),
    "graph_list": _with(
        GRAPH, "SELECT node_id, label, name, weight FROM nodes ORDER BY node_id LIMIT 100"
    ),
    "graph_visible": _with(VISIBLE, "SELECT * FROM shown"),
    "graph_neighbourhood": _with(
        f"""{GRAPH},
        near AS (SELECT * FROM edges_s WHERE src = 'MARCA:acme' OR dst = 'MARCA:acme')""",
        """SELECT node_id AS element, weight, sentiment FROM nodes_s
        WHERE node_id = 'MARCA:acme' OR node_id IN (SELECT src FROM near)
           OR node_id IN (SELECT dst FROM near)
        UNION ALL SELECT src || '->' || dst || ':' || rel, weight, sentiment FROM near""",
    ),
    "graph_brand_neighbours": _with(
        GRAPH,
        """SELECT * FROM edges_s WHERE src LIKE 'MARCA:%' OR dst LIKE 'MARCA:%'
        ORDER BY weight DESC, src, dst, rel LIMIT 100""",
    ),
    "graph_scaled": _with(
        f"""{VISIBLE},
        between_shown AS (
          SELECT * FROM edges WHERE src IN (SELECT node_id FROM shown)
          AND dst IN (SELECT node_id FROM shown)
        ),
        sized AS (
          SELECT node_id AS element, weight, ln(greatest(2, weight)) AS l, 0.6 AS same, 'n' AS part
          FROM shown
          UNION ALL
          SELECT src || '->' || dst || ':' || rel, weight, ln(greatest(2, weight)), 0.5, 'e'
          FROM between_shown
        ),
        bounds AS (
          SELECT *, min(l) OVER (PARTITION BY part) AS lo, max(l) OVER (PARTITION BY part) AS hi
          FROM sized
        )""",
        """SELECT element, weight,
        round(CASE WHEN hi > lo THEN (l - lo) / (hi - lo) ELSE CAST(same AS DOUBLE) END, 6) AS size
        FROM bounds""",
    ),
    "session_graph": _with(SESSION, f"SELECT {SESSION_LIST} FROM classed"),
    "session_graph_capped": _capped(SESSION),
    "session_graph_ties": _capped(
        SESSION.replace(" FROM facts", " FROM day_facts").replace(
            "touches AS (",
            "day_facts AS (SELECT * REPLACE (date_trunc('day', ts) AS ts) FROM facts),\ntouches AS (",
        )
    ),
    "applied_batches": _with(FACTS, "SELECT count(DISTINCT batch_id) AS batches FROM stats"),
    # E
    "minute_buckets": _with(BUCKETS, "SELECT bucket, sentiment, mentions FROM buckets"),
    "trend": _with(
        BUCKETS,
        """SELECT bucket,
        CAST(coalesce(sum(mentions) FILTER (WHERE sentiment = 'POSITIVO'), 0) AS BIGINT) AS "POSITIVO",
        CAST(coalesce(sum(mentions) FILTER (WHERE sentiment = 'NEUTRAL'), 0) AS BIGINT) AS "NEUTRAL",
        CAST(coalesce(sum(mentions) FILTER (WHERE sentiment = 'NEGATIVO'), 0) AS BIGINT) AS "NEGATIVO",
        CAST(sum(mentions) AS BIGINT) AS total
        FROM buckets GROUP BY bucket""",
    ),
    "kpis": _with(KPIS, "SELECT * FROM kpis"),
    "kpi_ratios": _with(
        KPIS,
        """SELECT *, round(100.0 * correct / labelled, 2) AS accuracy,
        round(100.0 * positive / total, 1) AS pct_positive,
        round(100.0 * neutral / total, 1) AS pct_neutral,
        round(100.0 * negative / total, 1) AS pct_negative FROM kpis""",
    ),
    "accuracy_pct": _with(
        FACTS,
        """SELECT expected, sentiment AS predicted, count(*) AS mentions,
        round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct
        FROM facts WHERE expected IS NOT NULL GROUP BY 1, 2""",
    ),
    "confusion": _with(
        FACTS,
        """SELECT coalesce(expected, 'SIN_ETIQUETA') AS expected, sentiment AS predicted,
        count(*) AS total FROM facts GROUP BY 1, 2""",
    ),
    "confusion_documents": _over(
        DOCUMENT_TEXTS,
        SCORES,
        """SELECT CASE WHEN l.doc_id IS NULL THEN 'SIN_ETIQUETA' WHEN toxic = 1 THEN 'NEGATIVO'
             WHEN quality = 1 THEN 'POSITIVO' ELSE 'NEUTRAL' END AS expected,
        sentiment AS predicted, count(*) AS total
        FROM scores LEFT JOIN labels l ON 'd' || l.doc_id = mention_id GROUP BY 1, 2""",
    ),
    "class_accuracy": _with(
        FACTS,
        """SELECT expected, count(*) AS total,
        count(*) FILTER (WHERE expected = sentiment) AS correct,
        round(100.0 * count(*) FILTER (WHERE expected = sentiment) / count(*), 2) AS accuracy
        FROM facts WHERE expected IS NOT NULL GROUP BY expected""",
    ),
    "latest_mentions": _with(
        FACTS,
        f"""SELECT mention_id, {TS.format('ts')} AS ts, platform, author, text, sentiment, score,
        confidence, {JOINED.format('keywords')}, expected,
        CAST(expected = sentiment AS VARCHAR) AS correct, decisions, opinions, tokens
        FROM (SELECT * FROM facts ORDER BY ts DESC, mention_id LIMIT 200)""",
    ),
    "batch_list": _with(
        FACTS,
        f"""SELECT batch_id, {TS.format('processed_at')} AS processed_at, messages, total_tokens,
        decisions, opinions, bound, max_tokens FROM stats ORDER BY batch_id DESC LIMIT 40""",
    ),
    "batch_totals": _with(
        FACTS,
        """SELECT CAST(sum(messages) AS BIGINT) AS messages,
        CAST(sum(total_tokens) AS BIGINT) AS total_tokens, CAST(sum(decisions) AS BIGINT) AS decisions,
        CAST(sum(opinions) AS BIGINT) AS opinions, CAST(sum(bound) AS BIGINT) AS bound,
        max(max_tokens) AS max_tokens FROM stats""",
    ),
    "work_ratio": _with(
        FACTS, "SELECT round(sum(decisions) / nullif(sum(bound), 0), 2) AS work_ratio FROM stats"
    ),
    "newest_batches": _with(
        FACTS,
        """SELECT batch_id, messages, total_tokens, decisions, opinions, bound, max_tokens
        FROM stats ORDER BY batch_id DESC LIMIT 8""",
    ),
    "health": _with(
        FACTS,
        f"""SELECT 'ok' AS status, 'acme' AS brand, max(batch_id) AS last_batch,
        {TS.format('max(processed_at)')} AS last_updated,
        (SELECT count(*) FROM mentions) AS mentions FROM stats""",
    ),
    "source_platform": _with(
        FACTS, "SELECT source, platform, count(*) AS mentions FROM facts GROUP BY source, platform"
    ),
    "batch_counters": _with(FACTS, f"SELECT {STATS_LIST} FROM stats"),
    "batch_accuracy": _with(
        FACTS,
        """SELECT batch_id, messages, correct, round(100.0 * correct / messages, 2) AS accuracy
        FROM stats""",
    ),
    "batch_summary": _with(
        f"""{GRAPH},
        node_counts AS (
          SELECT batch_id, count(DISTINCT label || ':' || name) AS nodes FROM node_rows GROUP BY batch_id
        ),
        edge_counts AS (
          SELECT batch_id, count(DISTINCT src || '>' || dst || ':' || rel) AS edges FROM edge_rows
          GROUP BY batch_id
        )""",
        """SELECT batch_id, messages, round(100.0 * correct / messages, 2) AS accuracy, decisions,
        bound, opinions, max_tokens, positive, neutral, negative, nodes, edges
        FROM stats JOIN node_counts USING (batch_id) JOIN edge_counts USING (batch_id)""",
    ),
    # F, G
    "work_bound": _over(
        MENTION_TEXTS,
        SCORES,
        """SELECT mention_id, tokens,
        CAST(CASE WHEN tokens > 1 THEN ceil(tokens * log2(tokens) - tokens + 1) ELSE 0 END AS BIGINT)
        AS bound FROM scores""",
    ),
    "global_sort": _with(
        FACTS, "SELECT mention_id, score FROM facts ORDER BY score DESC, mention_id"
    ),
    "merge_sorted": _with(
        MENTIONS,
        "SELECT mention_id, brand, author_followers FROM mentions ORDER BY author_followers, mention_id",
    ),
    "keyword_topk": _with(
        f"""{FACTS},
        counted AS (
          SELECT batch_id, k AS keyword, count(*) AS mentions
          FROM (SELECT batch_id, unnest(keywords) AS k FROM facts) GROUP BY 1, 2
        ),
        placed_keywords AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY mentions DESC, keyword)
                         AS INTEGER) AS place
          FROM counted
        )""",
        "SELECT batch_id, keyword, mentions, place FROM placed_keywords WHERE place <= 5",
    ),
    # H
    "stream_source": _with(
        MENTIONS,
        """SELECT mention_id, platform, author, text FROM raw_mentions
        WHERE mention_id IS NOT NULL AND text IS NOT NULL""",
    ),
    "stream_run": _with(CLEAN_FACTS, f"SELECT {STORED} FROM clean_facts"),
    "stream_restart": _with(
        CLEAN_FACTS, f"SELECT {STORED}, CAST(1 AS BIGINT) AS runs FROM clean_facts"
    ),
    "sink_idempotent": _with(CLEAN_FACTS, f"SELECT {STORED} FROM clean_facts"),
    "graph_seed": _with(
        GRAPH,
        "SELECT * EXCLUDE (rn) FROM ranked WHERE label IN ('MARCA', 'PLATAFORMA') OR rn <= 90",
    ),
    "stream_outputs": _with(
        CLEAN_GRAPH,
        """SELECT 'rejects' AS output, 'author missing' AS part, count(*) AS n,
          CAST(sum(length(mention_id)) AS BIGINT) AS total
        FROM mentions WHERE n % 97 = 0 AND n % 83 <> 0 AND n % 89 <> 0
        UNION ALL SELECT 'ids', 'all', count(*), CAST(sum(length(mention_id)) AS BIGINT)
        FROM clean_facts
        UNION ALL SELECT 'buckets', sentiment, count(DISTINCT date_trunc('minute', ts)), count(*)
        FROM clean_facts GROUP BY sentiment
        UNION ALL SELECT 'nodes', label, count(*), CAST(sum(weight) AS BIGINT)
        FROM nodes_s GROUP BY label
        UNION ALL SELECT 'edges', rel, count(*), CAST(sum(weight) AS BIGINT)
        FROM edges_s GROUP BY rel
        UNION ALL SELECT 'batch_stats', 'acme', count(*), CAST(sum(tokens) AS BIGINT)
        FROM clean_facts""",
    ),
    "stream_late": _with(
        f"""{CLEAN_FACTS},
        timed AS (
          SELECT *, n % 10 = 0 AND ts >= max(ts) OVER () - INTERVAL 10 DAY AS kept_back
          FROM mentions
        ),
        mark AS (
          SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS too_late
          FROM timed WHERE NOT kept_back AND n % 83 <> 0 AND n % 89 <> 0
        )""",
        f"""SELECT {STORED} FROM clean_facts
        WHERE n IN (SELECT n FROM timed WHERE NOT kept_back) OR ts > (SELECT too_late FROM mark)""",
    ),
    "graph_folds": _with(CLEAN_GRAPH, "SELECT * FROM nodes_s"),
    "stream_buckets_replayed": _with(CLEAN_FACTS, CLEAN_BUCKETS),
    "graph_replay": _with(CLEAN_GRAPH, "SELECT * FROM nodes_s"),
    "stream_graph": _with(CLEAN_GRAPH, "SELECT * FROM edges_s"),
    "stream_buckets": _with(CLEAN_FACTS, CLEAN_BUCKETS),
    "stream_buckets_runs": _with(CLEAN_FACTS, CLEAN_BUCKETS),
    "stream_recovery": _with(CLEAN_FACTS, CLEAN_BUCKETS),
    "stream_recovery_stats": _with(
        CLEAN_FACTS,
        """SELECT run_id, 0 AS batch_id, count(mention_id) AS messages,
        coalesce(sum(tokens), 0)::BIGINT AS total_tokens,
        coalesce(sum(opinions), 0)::BIGINT AS opinions,
        count(*) FILTER (WHERE expected = sentiment) AS correct
        FROM (VALUES ('lost'), ('new')) runs(run_id)
        LEFT JOIN clean_facts ON (batch_id % 3 = 0) = (run_id = 'lost') GROUP BY 1""",
    ),
    "history_load": _with(FACTS, CLEAN_BUCKETS.replace("clean_facts", "facts")),
    "history_graph": _with(GRAPH, "SELECT * FROM nodes_s"),
    "replayed_batch": _with(
        CLEAN_FACTS,
        """SELECT 0 AS batch_id, count(*) AS messages, true AS timed, 1 AS last_batch FROM clean_facts
        UNION ALL SELECT 1, 0, true, 1""",
    ),
    "stream_dedup": _with(
        MENTIONS,
        """SELECT DISTINCT mention_id, platform, text FROM raw_mentions
        WHERE mention_id IS NOT NULL AND text IS NOT NULL""",
    ),
}

# The same rules behind SQL functions.
ORACLE |= {"sql_tokens": ORACLE["tokenize"], "sql_opinions": ORACLE["opinions_ranked"]}

# The same reports over a store.
ORACLE |= {
    "store_trend": ORACLE["trend"].replace("SELECT bucket,", "SELECT CAST(bucket AS VARCHAR) AS bucket,"),
    "store_minutes": ORACLE["minute_buckets"],
    "store_latest": ORACLE["latest_mentions"],
    "store_kpis": ORACLE["kpi_ratios"].replace(
        "SELECT *, round", "SELECT * EXCLUDE (authors), true AS authors_close, round"
    ),
}
