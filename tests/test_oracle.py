"""Every registered query with check SQL gives the SQL result."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_matches_sql(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, sf_dir)
    assert ok, note


def test_entry(spark):
    table = entry_points.entry(spark)
    assert table.columns[0] == "channel" and table.count() == 5


def test_keys():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
