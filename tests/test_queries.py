"""Every registered query against its SQL twin; queries without one must give rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle import differences


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, sf, name):
    assert differences(spark, name, sf) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, sf, name):
    rows = entry.queries()[name](spark, sf).collect()
    assert rows and not any(v != v for r in rows for v in r if v is not None)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
