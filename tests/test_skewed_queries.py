"""Registered queries on copies of the tables in which one key holds a third of the rows,
with a hot-key limit low enough that the split forms run."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from lakeloom.operators.windows import hot_keys
from lakeloom.session import table
from tests.conftest import SMALL
from tests.oracle import TABLES, compare, connect

SKEW = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": "* REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id)",
}
NAMES = """e01_ranking e02_lag_lead e03_running_totals e04_moving_frame e05_range_frame e06_whole_partition_frame e07_unpartitioned_rank
e11_surrogate_key f03_top_k_per_group c01_inner_join c02_left_join d09_salted_aggregate m11_as_of_join n07_customer_dimension q10_spend_segments""".split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    where, con = tmp_path_factory.mktemp("skewed"), duckdb.connect()
    for name in TABLES:
        con.execute(f"COPY (SELECT {SKEW.get(name, '*')} FROM read_parquet('{SMALL}/{name}.parquet')) TO '{where}/{name}.parquet' (FORMAT parquet)")
    return str(where)


@pytest.fixture(autouse=True)
def low_limit(spark):
    spark.conf.set("spark.lakeloom.hotRows", "100")
    yield
    spark.conf.unset("spark.lakeloom.hotRows")


def test_the_copy_is_skewed(spark, folder):
    orders = table(spark, folder, "orders")
    found = hot_keys(orders, ["o_custkey"])
    assert [r["o_custkey"] for r in found.rows] == [7] and found.rows[0]["_n"] * 3 >= orders.count()


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_tables(spark, folder, name):
    status, note = compare(spark, connect(folder), name, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert status == "ok", note
