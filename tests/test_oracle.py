"""Every registered query against its SQL oracle (DuckDB) on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_compare import compare, duck

NAMES = sorted(E.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF001), E.oracle_sql()[name], SF001, con=con)
    assert ok, msg


def test_entry(spark):
    assert E.entry(spark).count() > 0
