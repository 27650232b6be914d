"""Analysis queries, checks and the general operators, registered by key.

Source-level analyses read the source tables as they arrive (duplicates and
the year bug included), exactly like the exploration queries they re-express;
the others read the operational and reporting tables.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as fn
from .. import labels as L
from ..functions import count_if, exact_mean, exact_sum, mean, money, pct, round_half, safe_div
from ..operators import count_share, dedupe, diff_snapshots, exact_median, share_of_total, unpivot_columns, weighted_average
from ..params import Params
from ..session import checkpoint_dir
from ..sources import read_driver
from . import checks, ops, reports
from .pipeline import Pipeline
from .registry import QUERIES, pipeline, register
from .store import Store


def _inbound():
    return F.col("channel") == L.INBOUND


def _outbound():
    return F.col("channel") == L.OUTBOUND


def _channel_from_form(form: str = "form_submission_date"):
    return F.when(F.col(form).isNotNull(), F.lit(L.INBOUND)).otherwise(F.lit(L.OUTBOUND))


def _asc(c):
    """Ascending with NULLs last (NULL sorts as the largest value)."""
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def _desc(c):
    """Descending with NULLs first (NULL sorts as the largest value)."""
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def _rank(c: str, order: tuple[str, ...]):
    """ORDER BY CASE c WHEN order[0] THEN 1 ... END (others, NULL last)."""
    expr = None
    for i, v in enumerate(order, start=1):
        expr = F.when(F.col(c) == v, F.lit(i)) if expr is None else expr.when(F.col(c) == v, F.lit(i))
    return expr.asc_nulls_last()


def _converted():
    return F.col("converted_opportunity_id").isNotNull()


def _text_date(c):
    return F.date_format(c, "yyyy-MM-dd")


# ------------------------------------------------------------ discovery
@register("q01_volumes")
def q01_volumes(spark: SparkSession, sf: str) -> DataFrame:
    pl = pipeline(spark, sf)
    fmt = "yyyy-MM-dd HH:mm:ss"
    leads = pl.ingress_leads.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("form_submission_date").alias("lo"), F.max("form_submission_date").alias("hi"))
    opps = pl.ingress_opportunities.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.col("created_date").cast("date")).cast("timestamp_ntz").alias("lo"),
        F.max(F.col("created_date").cast("date")).cast("timestamp_ntz").alias("hi"))
    out = []
    for name, df in (("leads", leads), ("opportunities", opps)):
        out.append(df.select(F.lit(name).alias("table_name"), "row_count",
                             F.date_format("lo", fmt).alias("min_date"), F.date_format("hi", fmt).alias("max_date")))
    return out[0].unionByName(out[1])


@register("q02_status_mix")
def q02_status_mix(spark: SparkSession, sf: str) -> DataFrame:
    return count_share(pipeline(spark, sf).ingress_leads, ["status"], "cnt", "pct").orderBy(_desc("cnt"))


@register("q03_stage_mix")
def q03_stage_mix(spark: SparkSession, sf: str) -> DataFrame:
    return count_share(pipeline(spark, sf).ingress_opportunities, ["stage_name"], "cnt", "pct").orderBy(_desc("cnt"))


@register("q04_channel_conversion")
def q04_channel_conversion(spark: SparkSession, sf: str) -> DataFrame:
    src = pipeline(spark, sf).ingress_leads
    g = src.groupBy(_channel_from_form().alias("channel")).agg(
        F.count(F.lit(1)).alias("leads"), count_if(_converted()).alias("converted"))
    return g.withColumn("conversion_rate_pct", pct("converted", "leads"))


@register("q05_lost_reasons")
def q05_lost_reasons(spark: SparkSession, sf: str) -> DataFrame:
    lost = pipeline(spark, sf).ingress_opportunities.filter(F.col("stage_name") == L.STAGE_CLOSED_LOST)
    return count_share(lost, ["lost_reason_c", "demo_held"], "cnt", "pct").orderBy(_desc("cnt"))


@register("q06_weekly_win_rate")
def q06_weekly_win_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly closes on the source close_date (year bug not corrected)."""
    src = pipeline(spark, sf).ingress_opportunities
    closed = src.filter(F.col("stage_name").isin(L.STAGE_CLOSED_WON, L.STAGE_CLOSED_LOST) & F.col("close_date").isNotNull())
    g = closed.groupBy(fn.week_start("close_date").alias("wk")).agg(
        count_if(F.col("stage_name") == L.STAGE_CLOSED_WON).alias("won"),
        count_if(F.col("stage_name") == L.STAGE_CLOSED_LOST).alias("lost"),
        F.count(F.lit(1)).alias("total_closed"))
    return g.select(_text_date(F.col("wk")).alias("close_week"), "won", "lost", "total_closed",
                    pct("won", "total_closed").alias("win_rate_pct")).orderBy(_asc("close_week"))


def _lead_rollup(leads: DataFrame) -> DataFrame:
    """Source leads pre-aggregated per (converted_opportunity_id, channel).

    The join that follows sees one row per opportunity and channel: an
    opportunity that a third of all leads point to costs one row per map task
    (partial aggregation), never its whole group in one task.
    """
    touches = (F.coalesce("sales_call_count", F.lit(0)) + F.coalesce("sales_text_count", F.lit(0))
               + F.coalesce("sales_email_count", F.lit(0)))
    pred = fn.decimal_comma("predicted_sales_with_owner")
    return (
        leads.filter(F.col("converted_opportunity_id").isNotNull())
        .groupBy("converted_opportunity_id", _channel_from_form().alias("channel"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(money(pred)).alias("pred_sum"),
            F.count(pred).alias("pred_n"),
            F.sum("location_count").alias("loc_sum"),
            F.count("location_count").alias("loc_n"),
            count_if(F.col("connected_with_decision_maker")).alias("dm_n"),
            F.sum(touches).alias("touch_sum"),
        )
    )


@register("q07_lost_reason_by_channel")
def q07_lost_reason_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    pl = pipeline(spark, sf)
    lost = pl.ingress_opportunities.filter(F.col("stage_name") == L.STAGE_CLOSED_LOST).select(
        "opportunity_id", "lost_reason_c", "demo_held")
    roll = _lead_rollup(pl.ingress_leads).select("converted_opportunity_id", "channel", "n")
    j = lost.join(roll, lost.opportunity_id == roll.converted_opportunity_id, "inner")
    g = j.groupBy("channel", "lost_reason_c", "demo_held").agg(F.sum("n").cast("bigint").alias("cnt"))
    return share_of_total(g, "cnt", "pct_within_channel", within=["channel"]).orderBy(_asc("channel"), _desc("cnt"))


@register("q08_speed_buckets")
def q08_speed_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """No guards: a contact before the form falls in the first bucket."""
    src = pipeline(spark, sf).ingress_leads
    contact = F.least("first_sales_call_date", "first_text_sent_date")
    rows = src.filter(F.col("form_submission_date").isNotNull() & contact.isNotNull()).select(
        fn.minute_diff("form_submission_date", contact).alias("mins"), "converted_opportunity_id")
    labels = L.Q_SPEED_LABELS
    bucket = fn.upper_bucket("mins", [5, 15, 60, 1440, 4320], labels, labels[-1])
    g = rows.groupBy(bucket.alias("speed_bucket")).agg(
        F.count(F.lit(1)).alias("leads"), count_if(_converted()).alias("converted"))
    return g.withColumn("conversion_rate_pct", pct("converted", "leads")).orderBy(_asc("speed_bucket"))


@register("q09_decision_maker")
def q09_decision_maker(spark: SparkSession, sf: str) -> DataFrame:
    src = pipeline(spark, sf).ingress_leads
    g = src.groupBy(_channel_from_form().alias("channel"), "connected_with_decision_maker").agg(
        F.count(F.lit(1)).alias("leads"), count_if(_converted()).alias("converted"))
    return g.withColumn("conversion_rate_pct", pct("converted", "leads")).orderBy(
        _asc("channel"), _asc("connected_with_decision_maker"))


@register("q10_no_demo_weekly")
def q10_no_demo_weekly(spark: SparkSession, sf: str) -> DataFrame:
    src = pipeline(spark, sf).ingress_opportunities
    lost = src.filter((F.col("stage_name") == L.STAGE_CLOSED_LOST) & F.col("close_date").isNotNull())
    g = lost.groupBy(fn.week_start("close_date").alias("wk")).agg(
        F.count(F.lit(1)).alias("total_closed_lost"),
        count_if(F.col("lost_reason_c") == L.REASON_NO_DEMO).alias("no_demo_held"))
    return g.select(_text_date(F.col("wk")).alias("close_week"), "total_closed_lost", "no_demo_held",
                    pct("no_demo_held", "total_closed_lost").alias("no_demo_pct")).orderBy(_asc("close_week"))


@register("q11_working_age")
def q11_working_age(spark: SparkSession, sf: str) -> DataFrame:
    """Age buckets of Working leads, measured to the run's as-of date."""
    pl = pipeline(spark, sf)
    src = pl.ingress_leads.filter(F.col("status") == L.STATUS_WORKING)
    since = fn.day_diff(F.coalesce("last_sales_activity_date", "first_sales_call_date", "first_text_sent_date",
                                   "form_submission_date"), fn.date_literal(pl.p.as_of))
    touches = (F.coalesce("sales_call_count", F.lit(0)) + F.coalesce("sales_text_count", F.lit(0))
               + F.coalesce("sales_email_count", F.lit(0)))
    labels = L.Q_AGE_LABELS
    rows = src.select(fn.upper_bucket(since, [30, 60, 90, 180], labels, labels[-1]).alias("age_bucket"),
                      touches.alias("total_touches"),
                      fn.decimal_comma("predicted_sales_with_owner").alias("predicted_sales"))
    return rows.groupBy("age_bucket").agg(
        F.count(F.lit(1)).alias("leads"),
        round_half(mean("total_touches"), 1).alias("avg_touches"),
        round_half(exact_mean("predicted_sales"), 0).alias("avg_predicted_sales")).orderBy(_asc("age_bucket"))


@register("q12_won_profile")
def q12_won_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profile of won deals; opportunity cycle time from the entity layer."""
    pl = pipeline(spark, sf)
    won = pl.entity_opportunities.filter(
        (F.col("stage_name") == L.STAGE_CLOSED_WON) & F.col("close_date").isNotNull()).select(
        "opportunity_id", "days_to_close")
    roll = _lead_rollup(pl.ingress_leads)
    j = won.join(roll, won.opportunity_id == roll.converted_opportunity_id, "inner")
    days_n = F.when(F.col("days_to_close").isNotNull(), F.col("n"))
    g = j.groupBy("channel").agg(
        F.sum("n").cast("bigint").alias("won_deals"),
        F.sum("pred_sum").alias("pc"), F.sum("pred_n").alias("pn"),
        F.sum("loc_sum").alias("ls"), F.sum("loc_n").alias("ln"),
        F.sum("dm_n").alias("dm"), F.sum("touch_sum").alias("ts"),
        F.sum(F.col("days_to_close") * F.col("n")).alias("ds"), F.sum(days_n).alias("dn"))
    return g.select(
        "channel", "won_deals",
        round_half(safe_div("pc", "pn"), 0).alias("avg_predicted_sales"),
        round_half(safe_div("ls", "ln"), 1).alias("avg_locations"),
        round_half(safe_div("dm", "won_deals") * F.lit(100.0), 1).alias("dm_rate_pct"),
        round_half(safe_div("ts", "won_deals"), 1).alias("avg_touches"),
        round_half(safe_div("ds", "dn"), 1).alias("avg_days_to_close"))


@register("q13_value_tiers")
def q13_value_tiers(spark: SparkSession, sf: str) -> DataFrame:
    src = pipeline(spark, sf).ingress_leads
    p = fn.decimal_comma("predicted_sales_with_owner")
    v = L.Q_VALUE_LABELS
    tier = (F.when(p >= 5000, F.lit(v[0])).when(p >= 2000, F.lit(v[1])).when(p >= 1000, F.lit(v[2]))
            .when(p >= 500, F.lit(v[3])).when(p > 0, F.lit(v[4])).otherwise(F.lit(v[5])))
    g = src.groupBy(tier.alias("predicted_sales_tier")).agg(
        F.count(F.lit(1)).alias("total_leads"), count_if(_converted()).alias("converted"))
    return g.withColumn("conversion_rate_pct", pct("converted", "total_leads")).orderBy(_asc("predicted_sales_tier"))


# ------------------------------------------------------------ on ops/rpt
def _split(df: DataFrame, key: str, count_alias: str, pct_alias: str) -> DataFrame:
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_alias), count_if(_inbound()).alias("inbound"),
                            count_if(_outbound()).alias("outbound"))
    return share_of_total(g, count_alias, pct_alias)


@register("q14_loss_split")
def q14_loss_split(spark: SparkSession, sf: str) -> DataFrame:
    lost = pipeline(spark, sf).ops_opportunities.filter(F.col("is_closed_lost"))
    return _split(lost, "lost_reason_c", "lost_deals", "pct_of_losses").orderBy(_desc("lost_deals"))


@register("q15_status_split")
def q15_status_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(pipeline(spark, sf).ops_leads, "status", "lead_count", "pct_of_total").orderBy(_desc("lead_count"))


@register("q16_working_health")
def q16_working_health(spark: SparkSession, sf: str) -> DataFrame:
    working = pipeline(spark, sf).ops_leads.filter(F.col("status") == L.STATUS_WORKING)
    g = working.groupBy("working_lead_health").agg(
        F.count(F.lit(1)).alias("lead_count"), count_if(_inbound()).alias("inbound"), count_if(_outbound()).alias("outbound"),
        round_half(mean("days_since_last_activity"), 0).alias("avg_days_inactive"),
        round_half(mean("total_touch_count"), 1).alias("avg_touches"))
    return share_of_total(g, "lead_count", "pct_of_working").orderBy(_desc("lead_count"))


@register("q17_blended")
def q17_blended(spark: SparkSession, sf: str) -> DataFrame:
    m = pipeline(spark, sf).rpt_monthly_unit_economics
    c = F.col
    wins = c("inbound_wins") + c("outbound_wins")
    blended = safe_div(c("inbound_cac") * c("inbound_wins") + c("outbound_cac") * c("outbound_wins"), wins)
    return m.select(
        "expense_month", "inbound_leads", "outbound_leads", c("inbound_converted").alias("inbound_opps"),
        c("outbound_converted").alias("outbound_opps"), "inbound_wins", "outbound_wins", "inbound_cost_per_lead",
        "outbound_cost_per_lead", c("inbound_cost_per_opportunity").alias("inbound_cost_per_opp"),
        c("outbound_cost_per_opportunity").alias("outbound_cost_per_opp"), "inbound_cac", "outbound_cac",
        blended.alias("blended_cac")).orderBy(_asc("expense_month"))


@register("q18_demo_status")
def q18_demo_status(spark: SparkSession, sf: str) -> DataFrame:
    r = pipeline(spark, sf).rpt_pipeline_health.filter(F.col("record_type") == L.RECORD_OPPORTUNITY)
    return r.groupBy("channel", "demo_status").agg(
        F.sum("record_count").cast("bigint").alias("records"),
        round_half(exact_sum("total_forecasted_annual_revenue"), 0).alias("at_risk_annual_revenue"),
        weighted_average("avg_days_in_pipeline", "record_count", 0).alias("wtd_avg_days_in_pipeline"))\
        .orderBy(_desc("records"))


@register("q19_followup_losses")
def q19_followup_losses(spark: SparkSession, sf: str) -> DataFrame:
    pl = pipeline(spark, sf)
    lost = pl.ops_opportunities.filter(F.col("is_closed_lost") & F.col("lost_reason_c").isin(*pl.p.followup_reasons))
    return lost.groupBy("lost_reason_c").agg(
        F.count(F.lit(1)).alias("lost_deals"),
        round_half(mean(fn.day_diff("created_date", "close_date")), 0).alias("avg_days_to_close"),
        round_half(exact_sum(F.col("predicted_sales_with_owner") * F.lit(12.0)), 0)
        .alias("total_lost_annual_value")).orderBy(_desc("lost_deals"))


@register("q20_danger_zone")
def q20_danger_zone(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf).ops_pipeline_health
    rows = p.filter((F.col("record_type") == L.RECORD_OPPORTUNITY) & (F.col("demo_held") == F.lit(True)))
    return rows.groupBy("health_status", "pipeline_segment", "risk_level").agg(
        F.count(F.lit(1)).alias("records"),
        round_half(mean("days_in_pipeline"), 0).alias("avg_days"),
        round_half(mean("days_in_current_stage"), 0).alias("avg_days_in_stage"),
        round_half(exact_sum("forecasted_annual_revenue"), 0).alias("annual_rev"))\
        .orderBy(_asc("health_status"), _asc("pipeline_segment"))


@register("q21_lead_health")
def q21_lead_health(spark: SparkSession, sf: str) -> DataFrame:
    r = pipeline(spark, sf).rpt_pipeline_health.filter(F.col("record_type") == L.RECORD_LEAD)
    return r.groupBy("health_status").agg(
        F.sum("record_count").cast("bigint").alias("leads"),
        round_half(exact_sum("total_forecasted_annual_revenue"), 0).alias("forecasted_annual_revenue"),
        weighted_average("avg_days_in_pipeline", "record_count", 0).alias("wtd_avg_days"),
        weighted_average("avg_touch_count", "record_count", 1).alias("wtd_avg_touches"),
        weighted_average("decision_maker_pct", "record_count", 1).alias("wtd_dm_pct"))\
        .orderBy(_rank("health_status", (L.HEALTH_ACTIVE, L.HEALTH_AGING, L.HEALTH_STALE)))


@register("q22_outreach_mix")
def q22_outreach_mix(spark: SparkSession, sf: str) -> DataFrame:
    o = pipeline(spark, sf).rpt_lead_outreach_priority
    return o.groupBy("outreach_section", "outreach_priority", "dashboard_status").agg(
        F.count(F.lit(1)).alias("leads"),
        round_half(exact_sum("predicted_sales_with_owner"), 0).alias("total_predicted_value"),
        count_if(F.col("is_actionable")).alias("actionable"),
        count_if(F.col("is_high_value_urgent")).alias("high_value_urgent"))\
        .orderBy(_asc("outreach_section"), _rank("outreach_priority", (L.NO_OUTREACH_P0[0], L.NO_OUTREACH_P2[0],
                                                                     L.NO_OUTREACH_EXPIRED[0])))


@register("q23_health_tiers")
def q23_health_tiers(spark: SparkSession, sf: str) -> DataFrame:
    p = pipeline(spark, sf).ops_pipeline_health.filter(F.col("record_type") == L.RECORD_LEAD)
    return p.groupBy("channel", "health_status", "predicted_sales_tier").agg(
        F.count(F.lit(1)).alias("leads"),
        round_half(mean("days_in_pipeline"), 0).alias("avg_days_inactive"),
        round_half(mean("total_touch_count"), 1).alias("avg_touches"),
        round_half(exact_mean("forecasted_monthly_revenue"), 2).alias("avg_monthly_rev"),
        count_if(F.col("connected_with_decision_maker")).alias("dm_connected"))\
        .orderBy(_asc("channel"), _asc("health_status"), _desc("leads"))


ROW_COUNT_REPORTS = ("rpt_channel_efficiency", "rpt_pipeline_health", "rpt_monthly_unit_economics")


@register("q24_row_counts")
def q24_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the tables.

    The tables that are projections of leads or of opportunities are counted in
    one pass over each: one dedupe of the leads answers for three tables.  The
    reports read the same shared frames, so no source is read or shuffled twice.
    """
    pl = pipeline(spark, sf)
    deals, leads = pl.deals_and_leads()
    leads = leads.agg(F.count(F.lit(1)).alias("n"), count_if(ops.is_working_lead()).alias("working"),
                      count_if(reports.in_outreach_queue()).alias("queue"))
    deals = deals.agg(F.count(F.lit(1)).alias("n"), count_if(F.col("is_closed") == F.lit(False)).alias("open"))
    parts = [
        leads.select(F.stack(F.lit(3), F.lit("ops_leads"), "n", F.lit("ops_pipeline_health"), "working",
                             F.lit("rpt_lead_outreach_priority"), "queue").alias("model", "rows")),
        deals.select(F.stack(F.lit(2), F.lit("ops_opportunities"), "n", F.lit("ops_pipeline_health"), "open").alias("model", "rows")),
        *[pl.table(m).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(m).alias("model"), "rows") for m in ROW_COUNT_REPORTS],
    ]
    counted = reduce(DataFrame.unionByName, parts).groupBy("model").agg(F.sum("rows").alias("rows"))
    return counted.orderBy(_asc("model"))


QUERIES["q25_cac_ltv_read"] = lambda spark, sf: pipeline(spark, sf).present("rpt_cac_ltv_by_channel")
QUERIES["q26_funnel_read"] = lambda spark, sf: pipeline(spark, sf).present("rpt_funnel_summary")


# ------------------------------------------------------------ operators
@register("dedupe_leads")
def dedupe_leads(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline(spark, sf).raw_leads


@register("dedupe_opps")
def dedupe_opps(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources import as_text_timestamps
    return as_text_timestamps(pipeline(spark, sf).raw_opportunities)


@register("dedupe_opp_lead")
def dedupe_opp_lead(spark: SparkSession, sf: str) -> DataFrame:
    from .ops import one_lead_per_opportunity
    return one_lead_per_opportunity(pipeline(spark, sf).ops_leads).select(
        "converted_opportunity_id", "lead_id", "channel")


@register("distinct_expenses_advertising")
def distinct_expenses_advertising(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline(spark, sf).raw_expenses_advertising


@register("distinct_expenses_salary")
def distinct_expenses_salary(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline(spark, sf).raw_expenses_salary


@register("outreach_top100")
def outreach_top100(spark: SparkSession, sf: str) -> DataFrame:
    """The head of the outreach queue: a top-k report, the limit is the feature."""
    return reports.outreach_top(pipeline(spark, sf).rpt_lead_outreach_priority, 100)


# ------------------------------------------------------------ checks
@register("chk_closed_date")
def chk_closed_date(spark: SparkSession, sf: str) -> DataFrame:
    return checks.closed_without_close_date(pipeline(spark, sf))


@register("chk_flags_exclusive")
def chk_flags_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    return checks.closed_flags_both_true(pipeline(spark, sf))


@register("chk_negative_cost")
def chk_negative_cost(spark: SparkSession, sf: str) -> DataFrame:
    return checks.negative_cac_or_cost(pipeline(spark, sf))


@register("chk_orphans")
def chk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return checks.lead_orphans(pipeline(spark, sf))


@register("chk_parse_failures")
def chk_parse_failures(spark: SparkSession, sf: str) -> DataFrame:
    return checks.parse_failures(pipeline(spark, sf))


@register("chk_summary")
def chk_summary(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_summary(pipeline(spark, sf))


# ------------------------------------------- general operators on driver tables
@register("gen_dedupe_events")
def gen_dedupe_events(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event per user (ts DESC, NULL first; ties to the lowest
    event_id) — the dedupe operator."""
    ev = read_driver(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return dedupe(ev, "user_id", [F.col("ts").desc_nulls_first(), F.col("event_id").asc()], tie_break=None)


@register("gen_share_events")
def gen_share_events(spark: SparkSession, sf: str) -> DataFrame:
    """Share of total by event_type — the share-of-total operator."""
    ev = read_driver(spark, sf, "events", ["event_type"])
    return count_share(ev, ["event_type"], "cnt", "pct")


@register("gen_rolling_orders")
def gen_rolling_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly orders by status with a 3-row rolling mean and the lag."""
    o = read_driver(spark, sf, "orders", ["o_orderdate", "o_orderstatus", "o_totalprice"])
    m = o.groupBy(fn.month_start("o_orderdate").alias("month"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("revenue"))
    w = Window.partitionBy("o_orderstatus").orderBy("month").rowsBetween(-2, 0)
    w0 = Window.partitionBy("o_orderstatus").orderBy("month")
    from ..operators import rolling_count, rolling_mean
    return m.select("*", rolling_mean("orders", w, 1).alias("rolling_3_orders"),
                    rolling_mean("revenue", w, 2).alias("rolling_3_revenue"),
                    rolling_count(w).alias("window_rows"), F.lag("orders", 1).over(w0).alias("prev_orders"))


@register("gen_unpivot_lineitem")
def gen_unpivot_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Money columns of lineitem to rows, summed per flag and measure."""
    li = read_driver(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice", "l_discount", "l_tax"])
    long = unpivot_columns(li, ["l_returnflag"], ["l_extendedprice", "l_discount", "l_tax"], "measure", "amount")
    return long.groupBy("l_returnflag", "measure").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("amount").alias("total"))


@register("gen_anti_orders_customer")
def gen_anti_orders_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose customer is missing — the orphan check operator."""
    from ..operators import check_orphans
    o = read_driver(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = read_driver(spark, sf, "customer", ["c_custkey"])
    return check_orphans(o, "o_custkey", c, "c_custkey", ["o_orderkey", "o_custkey"])


@register("gen_median_events")
def gen_median_events(spark: SparkSession, sf: str) -> DataFrame:
    """Exact median of value per event type (rounded to 4 decimals)."""
    ev = read_driver(spark, sf, "events", ["event_type", "value"])
    found = exact_median(ev, ["event_type"], "value")
    return found.select("event_type", "n", round_half("median", 4).alias("median_value"))


@register("gen_parse_currency_lineitem")
def gen_parse_currency_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Currency text parsed back over a whole driver column, summed per flag (text straight to DECIMAL)."""
    li = read_driver(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice"])
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    text = F.concat(F.lit("US$    "), F.floor(cents / 100).cast("string"), F.lit(","),
                    F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"))
    parsed = li.select("l_returnflag", fn.exact_currency(text).alias("amount"))
    return parsed.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("total"))



# ------------------------------------------------------------ snapshot diff
def _earlier(pl: Pipeline) -> Params:
    """The parameters of ``pl`` as of ``snapshot_gap_days`` before."""
    day = dt.date.fromisoformat(pl.p.as_of) - dt.timedelta(days=pl.p.snapshot_gap_days)
    return dataclasses.replace(pl.p, as_of=day.isoformat())


_RECORD = (["record_type", "record_id"], ["health_status"], ["channel"])


@register("health_changes")
def health_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Records that entered or left the open pipeline, or whose health changed, between two days.

    Both snapshots are computed in one query and share the source plans, so the
    leads and opportunities are shuffled once for both.
    """
    pl = pipeline(spark, sf)
    return diff_snapshots(pl.shared.pipeline_health_on(_earlier(pl)), pl.ops_pipeline_health, *_RECORD)


@register("stored_health_changes")
def stored_health_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The same changes between two stored builds, one of each day, read by their run ids.

    Later builds don't touch what an earlier run has written, so any two runs of
    the manifest can be compared at any time.
    """
    pl = pipeline(spark, sf)
    base = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"
    for build in (Pipeline(spark, pl.sources, _earlier(pl), as_it_was=True), Pipeline(spark, pl.sources, pl.p)):
        build.materialize(base, ("ops_pipeline_health",))
    builds = Store(spark, base)
    older, newer = builds.runs()
    return diff_snapshots(builds.read("ops_pipeline_health", older), builds.read("ops_pipeline_health", newer), *_RECORD)
