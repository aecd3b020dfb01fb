"""Every registered query against its checking SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from tests import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key):
    problem, rows, _ = oracle.compare(spark, con, key, QUERIES[key], ORACLES.get(key), SF_DIR)
    assert problem is None
    assert rows >= 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
