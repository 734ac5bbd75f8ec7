"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SMALL
from eventlens.plans.oracles import oracle_sql
from eventlens.plans.queries import queries


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_registry():
    assert oracle_sql().keys() == queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).columns == ["minute", "revenue"]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    assert compare(queries()[name](spark, SMALL), duck, oracle_sql()[name]) is None
