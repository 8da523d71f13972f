"""Every registered query against the same query in DuckDB."""

import os

import pytest

import __spark_entry__ as entry
import compare
from tickloom.registry.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) <= set(entry.queries())
    assert set(all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    frame = entry.queries()[name](spark, SF_DIR)
    assert compare.difference(frame, con, entry.oracle_sql()[name]) is None
