"""Every registered query against its SQL. CURBLINE_SF_DIR chooses the scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from tests.oracle import connect, differences

SF_DIR = os.environ.get("CURBLINE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_sql():
    """The corpus queries say where they are checked instead."""
    own = registry.queries().keys() - registry._corpus_queries().keys()
    assert own <= registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", registry.oracle_sql().keys() - registry._corpus_sql().keys())
def test_query_matches_sql(spark, tables, name):
    rows = registry.queries()[name](spark, SF_DIR)
    assert differences(rows, tables, registry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert registry.entry(spark).count() == 24
