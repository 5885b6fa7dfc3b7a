"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SMALL
from wakeline import oracle, registry


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, SMALL).startswith("ok")


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
