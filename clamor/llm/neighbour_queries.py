"""Nearest neighbours of every twentieth vector among all of them.

SQL gives exact neighbours only; the tests compare with those.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clamor.llm.common import table
from clamor.llm.neighbours import nearest_neighbours


def op3_nearest_neighbours(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES = {"op3_nearest_neighbours": op3_nearest_neighbours}
ORACLES = {}
