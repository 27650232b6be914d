"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from pipewright.plans.registry import QUERIES


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udfs(spark, key):
    p = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dedupe_limits_rows_before_the_shuffle(spark):
    p = plan_of(QUERIES["dedupe_leads"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_null_keys_filtered_before_lead_shuffle(spark):
    p = plan_of(QUERIES["dedupe_opp_lead"](spark, SF_SMALL))
    # the NULL converted_opportunity_id rows are filtered below the partial limit
    lines = p.splitlines()
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit [converted_opportunity_id" in l and "Partial" in l)
    below = lines[partial + 1:]
    assert any("Filter" in l and "isnotnull(converted_opportunity_id" in l for l in below)


def test_one_lead_per_opportunity_shuffles_only_needed_columns(spark):
    df = QUERIES["ops_opportunities"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    ex = [l for l in p.splitlines() if "hashpartitioning(converted_opportunity_id" in l]
    assert ex
    p_opt = df._jdf.queryExecution().optimizedPlan().toString()
    # raw list columns never reach the opportunity join
    assert "cuisine_types_raw" not in p_opt


def test_scan_prunes_columns(spark):
    df = QUERIES["gen_share_events"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in p


def test_filters_reach_the_scan(spark):
    df = QUERIES["gen_anti_orders_customer"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_custkey)]" in p


def test_sources_are_whole_tables(spark):
    for name, column in (("src_opportunities", "c_custkey"), ("src_leads", "o_orderkey"), ("src_expenses_salary", "o_orderkey")):
        p = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert column in p and "Filter" not in p


def test_medians_hold_no_group_in_one_task(spark):
    p = QUERIES["gen_median_events"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "median(" not in p and "percentile_approx" in p
    # nor in one array: the only collected things are sketches
    assert "collect_list" not in p and "collect_set" not in p


def test_dedupe_keeps_scan_pruning_on_parquet_sources(spark):
    """Ties go by row position, so a report reads only the lead columns it uses."""
    from pipewright.plans import Pipeline
    from pipewright.session import checkpoint_dir
    from pipewright.sources import Sources

    base = f"{checkpoint_dir(spark).rstrip('/')}/test-pruning-sources"
    drv = Sources.from_driver(spark, SF_SMALL)
    paths = {}
    for key, df in (("leads", drv.leads), ("opportunities", drv.opportunities),
                    ("expenses_advertising", drv.expenses_advertising),
                    ("expenses_salary_and_commissions", drv.expenses_salary)):
        paths[key] = f"{base}/{key}"
        df.write.mode("overwrite").parquet(paths[key])
    pl = Pipeline(spark, Sources.from_parquet(spark, paths))
    plan = pl.rpt_funnel_summary._jdf.queryExecution().executedPlan().toString()
    lead_scans = [l for l in plan.splitlines() if "ReadSchema" in l and "lead_id" in l]
    assert lead_scans
    for line in lead_scans:
        assert "cuisine_types" not in line and "marketplaces_used" not in line
        assert "_tmp_metadata_row_index" in line          # the position comes from the reader


def static_plan(spark, df) -> str:
    """The plan before runtime statistics: no adaptive execution, no broadcast by size."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        return df._jdf.sparkSession().sessionState().executePlan(
            df._jdf.queryExecution().logical(), df._jdf.queryExecution().mode()).executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def exchanges(plan: str, key: str) -> int:
    return sum(f"hashpartitioning({key}#" in l and "ReusedExchange" not in l for l in plan.splitlines())


@pytest.mark.parametrize("key", ["rpt_funnel_summary", "rpt_monthly_unit_economics", "rpt_channel_efficiency", "q17_blended",
                                 "q26_funnel_read", "ops_pipeline_health", "rpt_pipeline_health", "health_changes", "q24_row_counts"])
def test_leads_are_shuffled_by_their_key_once(spark, key):
    plan = static_plan(spark, QUERIES[key](spark, SF_SMALL))
    assert exchanges(plan, "lead_id") == 1 and exchanges(plan, "opportunity_id") == 1
    assert exchanges(plan, "converted_opportunity_id") == 1 and "ReusedExchange" in plan


def test_checks_read_each_source_once(spark):
    plan = static_plan(spark, QUERIES["chk_summary"](spark, SF_SMALL))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l]
    assert len(scans) == 4  # leads, opportunities and the two ledgers
    assert exchanges(plan, "lead_id") == exchanges(plan, "opportunity_id") == exchanges(plan, "converted_opportunity_id") == 1
