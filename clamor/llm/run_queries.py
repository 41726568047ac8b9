"""Periodic runs of all documents.  SQL cannot express the search."""

from __future__ import annotations

import zlib

import numpy as np

from clamor.llm.common import table
from clamor.llm.periodic_runs import collapse_runs


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words that stand in for those of a tenth of all documents."""
    number = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if number % 10 or not n:
        return None
    group = number // 10
    first = group % n
    period = 1 + (n - first) // (3 + group % 8)
    places = np.arange(n)
    places[first:] = first + (places[first:] - first) % period
    return places


def op13_periodic_runs(spark, sf_dir):
    found = collapse_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256",
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLES = {}
