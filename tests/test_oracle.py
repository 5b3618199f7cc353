"""Every registered query agrees with its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
import compare


@pytest.fixture(scope="module")
def con(small=None):
    return compare.connect("/root/testdata/sf0.001")


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, small, name):
    assert compare.compare(spark, con, small, name) == ""


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
