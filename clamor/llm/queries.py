"""All queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from clamor.llm import (
    chat_queries,
    exact_queries,
    license_queries,
    neighbour_queries,
    run_queries,
    simhash_queries,
    substring_queries,
    token_queries,
    toxicity_queries,
    url_queries,
)

_MODULES = [
    license_queries,
    url_queries,
    neighbour_queries,
    chat_queries,
    token_queries,
    simhash_queries,
    substring_queries,
    toxicity_queries,
    exact_queries,
    run_queries,
]

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
