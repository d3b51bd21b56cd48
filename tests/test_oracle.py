"""Every registered query with SQL, compared at the smallest scale."""

import pytest
from oracle import connect, differences

from docquarry import catalog

FOLDER = "/root/testdata/sf0.001"
# Too few rows at this scale for the condition to find any.
MAY_BE_EMPTY = {"unknown_field"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, con, name):
    problems = differences(spark, con, name, catalog.QUERIES[name], catalog.SQL[name], FOLDER)
    assert [p for p in problems if "empty on both sides" not in p] == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs_without_sql(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 10
    assert set(oracle_sql()) <= set(queries())
