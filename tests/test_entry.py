"""Driver contract: entry() and every registered query run at sf0.001."""

import os

import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) == {"topic", "status", "records"}


def test_every_query_has_an_oracle_or_is_listed():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SMOKE)
    df.collect()
    assert len(df.columns) == len(set(df.columns))
