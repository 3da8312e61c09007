"""Every query next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, small, name):
    result = compare(spark, con, name, small)
    assert result.startswith("ok " if name in entry.oracle_sql() else "rows "), result
    assert not result.endswith(" 0"), "no rows"


def test_entry(spark):
    assert entry.entry(spark).count() == 1662
