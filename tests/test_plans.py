"""What the plans promise: pushed filters, narrow scans, group limits, no cross joins."""

import contextlib
import io
import re

import pytest

from outagelens.plans.queries import REGISTRY
from outagelens.sources import standins

SF_DIR = "/root/testdata/sf0.001"
# cost of building these is a write; their scans are covered by the others
WRITING = {
    "scan_year_partition", "scan_indicators_stored", "scan_csv_landing", "replace_year_idempotent", "write_match_check",
    "merge_schema_read", "reconcile_sum_gold", "ingest_files", "dedupe_across_loads", "run_summary", "csv_quarantine",
    "merge_schema_widened", "distinct_agents_stored_sketch", "duration_quantiles_stored_sketch", "scan_by_name", "dec_analysis_stored",
}


def plan(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        REGISTRY[name](spark, SF_DIR).explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITING))
def test_no_cross_join_and_no_python(name, spark):
    text = plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas", text)


@pytest.mark.parametrize("name", ["gold_outage_month", "dedupe_natural_key", "dedupe_indicators", "check_unique"])
def test_dedupe_limits_groups_before_the_exchange(name, spark):
    text = plan(spark, name)
    assert re.search(r"row_number\(\), 1, Partial", text) and re.search(r"row_number\(\), 1, Final", text)


def test_unused_lookups_are_not_joined(spark):
    assert "Join" not in plan(spark, "dist_by_voltage")
    assert "Join" not in plan(spark, "duration_class")
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan(spark, "conform_events"), re.M)) == 3


def test_a_short_list_of_suppliers_is_matched_in_place(spark, monkeypatch):
    def shuffles(threshold):
        monkeypatch.setattr(standins, "SHORT_LIST", threshold)
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            standins.events(spark, SF_DIR).explain("formatted")
        return re.findall(r"hashpartitioning\((l_\w+)", out.getvalue())

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(standins.SHORT_LIST) == ["l_orderkey", "l_partkey"]
        assert shuffles(0) == ["l_orderkey", "l_suppkey", "l_partkey"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scan_is_narrow_and_filtered(spark):
    text = plan(spark, "dist_by_voltage")
    assert "ReadSchema: struct<l_suppkey:bigint>" in text


def test_year_filter_prunes_partitions(spark):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        REGISTRY["scan_year_partition"](spark, SF_DIR).explain("formatted")
    assert re.search(r"PartitionFilters: \[.*_ano_fonte.* IN \(1997,1998\)", text.getvalue())


def test_wide_pivot_has_one_exchange_after_the_join(spark):
    text = plan(spark, "indicators_wide")
    assert len(re.findall(r"ENSURE_REQUIREMENTS", text)) == 1


def test_wide_pivot_sorts_by_a_number_first(spark):
    assert re.search(r"Arguments: \[_\w+#\d+L ASC", plan(spark, "indicators_wide"))


@pytest.mark.parametrize("name", ["count_by_agent", "top_volume", "sample_n", "bq_worst_distributor_year"])
def test_top_k_is_a_heap_not_a_sort(name, spark):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", [
    "coverage", "indicator_distribution", "top_volume", "top_mean_dec", "indicator_spread",
    "dec_fec_evolution", "null_keys", "period_month", "indicators_slice",
])
def test_measures_need_no_join(spark, name):
    assert "Join" not in plan(spark, name)
