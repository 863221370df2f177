"""Every registered query against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def duckdb():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin(spark, duckdb, name):
    actual = contract.queries()[name](spark, FOLDER).toPandas()
    assert difference(actual, duckdb.execute(contract.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
