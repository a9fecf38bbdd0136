"""Every registered query against its SQL on the supplied tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracle import compare, database


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, con, sf, name):
    assert compare(spark, con, sf, name) == []


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_prepared_reviews_add_twelve_columns(spark, sf):
    prepared = contract.queries()["prepared_reviews"](spark, sf)
    assert len(prepared.columns) == 11 + 12
    assert prepared.count() == 200
