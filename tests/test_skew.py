"""One order, agent, conjunto and start holding a third of all rows, against the oracles."""

import pytest

import __spark_entry__ as driver
from tests.comparing import TABLES, connect, differences

SOURCE = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()

# every third line becomes the same event; the price keeps the order total
HOT = """
SELECT if(hot, 7, l_orderkey) AS l_orderkey, if(hot, 5, l_partkey) AS l_partkey,
  if(hot, 3, l_suppkey) AS l_suppkey, CAST(if(hot, 1, l_linenumber) AS INT) AS l_linenumber,
  l_quantity, if(hot, CAST(n AS DOUBLE), l_extendedprice) AS l_extendedprice, l_discount,
  if(hot, 0.02, l_tax) AS l_tax, if(hot, 'A', l_returnflag) AS l_returnflag, l_linestatus,
  if(hot, TIMESTAMP '1998-05-05', l_shipdate) AS l_shipdate
FROM (SELECT *, row_number() OVER () AS n, row_number() OVER () % 3 = 0 AS hot FROM lineitem)
"""


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    con = connect(SOURCE)
    for name in TABLES:
        sql = HOT if name == "lineitem" else f"SELECT * FROM {name}"
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "dedupe_natural_key", "dedupe_order_number", "dedupe_order_uc", "dedupe_conjunto_start",
        "dedupe_indicators", "gold_outage_month", "indicators_wide", "gold_indicator_month",
        "dec_comparison", "check_report", "quality_summary", "reconcile_steps",
        "reconcile_sum_silver", "duration_stats", "profile_duplicates", "duplicate_examples",
        "conjunto_ranking", "bq_top_cause", "bq_missing_months", "enrich_region", "bq_missing_ranges",
        "limit_as_of", "cause_rollup", "bq_robust_jumps",
    ],
)
def test_hot_key(name, spark, hot_dir):
    assert differences(QUERIES[name](spark, hot_dir), connect(hot_dir), ORACLES[name]) == []


def test_without_broadcast(spark, hot_dir):
    """The same results when no side of a join is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("dec_comparison", "enrich_region", "duplicate_examples", "above_limit"):
            assert differences(QUERIES[name](spark, hot_dir), connect(hot_dir), ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
