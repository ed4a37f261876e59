"""Every checked query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from ragtables.checks.base import ORACLES, QUERIES
from oracle import connect, difference, sql_rows

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    sql = ORACLES.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        columns, types, rows = sql_rows(db, sql)
        assert rows and difference(df, columns, types, rows) is None


def test_only_searches_without_short_sql_go_unchecked():
    assert set(QUERIES) - set(ORACLES) == {"eval_rouge_l"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["row_id", "prompt"] and df.count() > 0
