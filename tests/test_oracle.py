"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as entry
from clamor.plans.oracle import ORACLE
from clamor.plans.queries import QUERIES
from compare import connect, difference
from conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_the_entry_names_them_all():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key):
    assert difference(spark, con, SF, QUERIES[key], ORACLE[key]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 1
