"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle import compare, connect

TWINS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, con, name):
    status, note = compare(spark, con, name, entry.queries()[name], TWINS.get(name), SMALL)
    assert status in ("ok", "rows"), note


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_custkey", "total_orders", "total_revenue", "avg_order_value", "last_order_date", "c_name", "c_mktsegment"]
    assert df.count() > 0


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(entry.queries())
