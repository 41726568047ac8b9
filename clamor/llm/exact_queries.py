"""The exact dedup query over all documents and its SQL."""

from __future__ import annotations

from clamor.llm.common import table
from clamor.llm.exact_dedup import exact_groups


def op10_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first(doc_id) OVER kept AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER kept = 1 AS kept, text_sha256
FROM keyed WINDOW kept AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST)
"""

QUERIES = {"op10_exact_dedup": op10_exact_dedup}
ORACLES = {"op10_exact_dedup": ORACLE}
