"""Toxicity of all documents.  SQL cannot express the training."""

from __future__ import annotations

from clamor.llm.common import table
from clamor.llm.toxicity import toxicity_scores


def op9_toxicity(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES = {}
