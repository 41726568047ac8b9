"""The queries that SQL can express, against their SQL."""

import pytest
from compare import connect, difference
from conftest import SF

from clamor.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", list(ORACLE))
def test_query(spark, con, key):
    assert difference(spark, con, SF, QUERIES[key], ORACLE[key]) == ""
