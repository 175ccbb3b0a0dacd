"""Every query with a twin gives the same rows as DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, connection, name):
    assert difference(entry.queries()[name](spark, SF_DIR), connection, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    result = entry.entry(spark)
    assert result.columns[:2] == ["window_start", "window_end"]
    assert result.count() > 0
