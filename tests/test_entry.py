"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from streamlake.plans.queries import QUERIES as LAKE

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from conftest import SF_DIR

    with connect(SF_DIR) as connection:
        yield connection


def test_every_lake_query_has_sql():
    assert set(LAKE) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) == ""


def test_flagship(spark):
    assert entry.entry(spark).count() == 10
