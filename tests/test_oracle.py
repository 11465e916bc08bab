"""Every registered query against its SQL counterpart on the smallest data."""

import pytest

import __spark_entry__ as entry
from catalogproof.queries import ORACLE as LIBRARY_ORACLE
from catalogproof.queries import QUERIES as LIBRARY_QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = LIBRARY_QUERIES, LIBRARY_ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r for r in rows if r["is_total"]] and len(rows) > 1
