"""SimHash groups of all documents.  The hashes are not at hand in SQL."""

from __future__ import annotations

from clamor.llm.common import table
from clamor.llm.simhash import hex_digits, near_groups


def op6_simhash_near_dedup(spark, sf_dir):
    groups = near_groups(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return groups.select("doc_id", hex_digits(groups.fp).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash_near_dedup": op6_simhash_near_dedup}
ORACLES = {}
