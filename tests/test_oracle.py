"""Every registered query against its SQL twin, on the smallest tables."""

from importlib import import_module

import pytest

import __spark_entry__ as entry
from tests import oracle

FOLDER = "/root/testdata/sf0.001"
CORE = [import_module(f"orderflow.registry.{name}") for name in entry._GROUPS]
QUERIES = {name: entry.queries()[name] for group in CORE for name in group.QUERIES}
SQL = {name: sql for group in CORE for name, sql in group.ORACLE.items()}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert oracle.difference(duck, QUERIES[name](spark, FOLDER), SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
