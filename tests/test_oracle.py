"""Every query against its oracle SQL on DuckDB, over whole tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_oracle(spark, con, name):
    assert compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
