"""The license query over all documents and its SQL."""

from __future__ import annotations

from clamor.llm.common import table
from clamor.llm.license_scan import license_scan, template_rows


def op1_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def _values() -> str:
    return ", ".join(
        f"({k}, '{label}', {base}, {pairs}, {need}, {votes}, {slack}, {j}, '{pair}')"
        for k, label, base, pairs, need, votes, slack, j, pair in template_rows()
    )


ORACLE = f"""
WITH template(template, label, base, pairs, need, votes_need, slack, j, pair) AS (VALUES {_values()}),
text AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
placed AS (SELECT row, words, unnest(range(len(words) - 1)) AS p FROM text WHERE len(words) > 1),
hits AS (
  SELECT row, t.*, p - j AS diagonal, p
  FROM placed JOIN template t ON pair = words[p + 1] || ' ' || words[p + 2]
),
strong AS (
  SELECT *, count(*) OVER (PARTITION BY row, template, diagonal) AS votes FROM hits
  QUALIFY votes >= votes_need
),
far AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER w > slack, false) AS far
  FROM strong WINDOW w AS (PARTITION BY row, template ORDER BY diagonal, p)
),
merged AS (
  SELECT *, count(*) FILTER (far) OVER (PARTITION BY row, template ORDER BY diagonal, p
    ROWS UNBOUNDED PRECEDING) AS span FROM far
),
span AS (
  SELECT row, template, label, base, span, min(p) AS start, count(DISTINCT j) / pairs AS score
  FROM merged GROUP BY row, template, label, base, span, need, pairs HAVING count(DISTINCT j) >= need
),
by_text AS (
  SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    list(DISTINCT label ORDER BY label) FILTER (base) AS base_labels,
    list(DISTINCT label ORDER BY label) AS labels, max(score) AS score, count(*) AS spans
  FROM span GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(base_labels, ','), '') AS base_labels,
  coalesce(array_to_string(labels, ','), '') AS labels,
  coalesce(score, 0) AS score, coalesce(spans, 0) AS spans
FROM text LEFT JOIN by_text USING (row)
"""

QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES = {"op1_license_scan": ORACLE}
