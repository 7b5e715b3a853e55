"""Plan shapes that matter at scale."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tillwise.workload.queries import QUERIES

PACKAGE = Path(entry.__file__).parent / "tillwise"


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pairwise_joins(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_daypart_join_is_a_broadcast_hash_join(spark, sf_dir):
    plan = _plan(QUERIES["assign_daypart_left"](spark, sf_dir))
    assert re.search(r"BroadcastHashJoin \[store_id#\d+\], \[_owner#\d+\], LeftOuter", plan)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_normalization_does_not_shuffle_the_fact(spark, sf_dir):
    plan = _plan(QUERIES["normalize_transactions"](spark, sf_dir))
    assert "Exchange hashpartitioning" not in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_lag_comparison_scans_the_fact_once(spark, sf_dir):
    for name in ("period_over_period", "comparison_group"):
        assert _plan(QUERIES[name](spark, sf_dir)).count("FileScan") == 1


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = _plan(QUERIES["comparison_group"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_audit_takes_two_shuffles_by_store_at_most(spark, sf_dir):
    from tillwise.operators import cohort
    from tillwise.sources.tables import literal_table
    from tillwise.workload.queries import RULES

    days = literal_table(spark, [], "store_id string, store_name string, business_day date, txn_count bigint")
    days = days.unionByName(spark.sql(
        "SELECT CAST(id AS STRING) AS store_id, 'n' AS store_name, DATE'1999-01-01' AS business_day, id AS txn_count FROM range(10)"
    ))
    plan = _plan(cohort.cohort_audit(days, RULES))
    assert plan.count("Exchange hashpartitioning(store_id") <= 2


def test_library_code_stays_declarative():
    banned = re.compile(
        r"\.(collect|toPandas|toLocalIterator|localCheckpoint|crossJoin|isEmpty|rdd|foreach\w*)\b|\b(pandas_udf|applyInPandas|mapInPandas|udf)\b|F\.broadcast\("
    )
    for file in (f for f in PACKAGE.rglob("*.py") if f.parent.name != "llm"):
        assert not banned.search(file.read_text()), file


def test_landed_snapshot_is_pruned_by_date(spark, sf_dir):
    from datetime import datetime

    from tillwise.operators import normalize
    from tillwise.sources.tables import snapshot_table
    from tillwise.workload import queries as Q, views

    landed = snapshot_table(views.event_authorizations(spark, sf_dir), Q._target(spark), "timestamp")
    rows = normalize.normalize_transactions(landed, views.merchant_map(spark), views.stores(spark), after=datetime(2024, 1, 19))
    assert re.search(r"PartitionFilters: \[[^\]]*timestamp_date", _plan(rows))


def test_readouts_scan_the_published_table_only(spark, sf_dir):
    for name in ("yoy_rollup_store", "contribution_weekday", "pivot_daily_sale"):
        plan = _plan(QUERIES[name](spark, sf_dir))
        assert "orders.parquet" not in plan and "FileScan parquet" in plan


def test_funnel_reads_documents_once(spark, sf_dir):
    plan = _plan(QUERIES["funnel_new_buyers"](spark, sf_dir))
    assert plan.count("orders.parquet") <= 1 and "Expand" not in plan
    assert "Expand" not in _plan(QUERIES["prior_buyer_rollcall"](spark, sf_dir))


def test_totals_fan_out_after_the_reduction(spark, sf_dir):
    lines = _plan(QUERIES["cohort_current_totals"](spark, sf_dir)).splitlines()
    fan_out = [i for i, line in enumerate(lines) if "Generate explode(array(struct(side, current" in line]
    assert len(fan_out) == 1
    assert "HashAggregate" in lines[fan_out[0] + 1]


def test_customer_reports_prune_the_published_dates(spark, sf_dir):
    from tillwise.operators import normalize
    from tillwise.plans import customer_reports
    from tillwise.workload import queries as Q

    published = normalize.publish_normalized(Q._normalized_orders(spark, sf_dir, "p_type").filter("store_id = 'S1'"), Q._target(spark))
    rows = customer_reports._normalized_sales(published, Q.LAUNCH)
    assert re.search(r"PartitionFilters: \[[^\]]*business_date#\d+ >= 2000-07-01", _plan(rows))
    assert {c for c in _plan(rows.select("account_id")).split("ReadSchema: struct<")[1].split(">")[0].split(",")} == {
        "account_id:string", "transaction_type:string", "check:string"
    }
