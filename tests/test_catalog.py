"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_catalog import connect, difference


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["id", "word_id", "cnt"]


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(name, spark, sf_dir, connection):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    if name in entry.oracle_sql():
        want = connection.execute(entry.oracle_sql()[name]).df()
        assert difference(got, want) is None
    else:
        assert len(got) > 0
