"""The registered queries against their SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload.base import QUERIES, SQL
from tools.check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir="/root/testdata/sf0.001"):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    ok, note = compare(spark, con, sf, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, note


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert "TotalSalesAmount" in entry.entry(spark).columns
