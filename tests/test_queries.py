"""Every registered query against its SQL in DuckDB, over the whole smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from testbed.check import differences, open_views
from testbed.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return open_views(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    assert differences(df, df.collect(), db.execute(contract.oracle_sql()[name])) == []


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
