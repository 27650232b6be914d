"""Reports over the operational tables.

Every report reduces a large table with one partial/final aggregation; what
follows the first aggregation is bounded by the number of channels, months or
segments, so joins there are broadcast automatically and the windows see a
handful of rows per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from .. import labels as L
from ..functions import count_if, exact_mean, exact_mean_of, exact_sum, mean, pct, round_half, safe_div
from ..operators import rolling_count, rolling_mean, trailing, ordered, unpivot_groups
from ..params import Params


# ------------------------------------------------------- rpt_cac_ltv_by_channel
def rpt_cac_ltv_by_channel(ops_opps: DataFrame, ops_exp: DataFrame, p: Params) -> DataFrame:
    """One row per channel: wins, six-month cost, CAC, revenue per deal, LTV and LTV:CAC."""
    won = (
        ops_opps.filter(F.col("is_closed_won"))
        .groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("deals_won"),
            round_half(exact_mean("monthly_subscription"), 2).alias("avg_monthly_subscription"),
            round_half(exact_mean("monthly_take_rate"), 2).alias("avg_monthly_take_rate"),
            round_half(exact_mean("monthly_revenue"), 2).alias("avg_monthly_revenue"),
        )
    )
    # both channel totals in one pass over the expenses, then two rows
    totals = ops_exp.agg(
        exact_sum("inbound_channel_cost").alias(L.INBOUND),
        exact_sum("outbound_channel_cost").alias(L.OUTBOUND),
    )
    costs = totals.select(F.stack(F.lit(2), F.lit(L.INBOUND), L.INBOUND, F.lit(L.OUTBOUND), L.OUTBOUND)
                          .alias("channel", "total_cost"))
    w = won.join(F.broadcast(costs), "channel", "inner")  # two rows: size bound is the channel count
    cac = round_half(F.col("total_cost") / F.col("deals_won"), 2)
    out = w.select("channel", "deals_won", F.col("total_cost").alias("total_cost_6mo"), cac.alias("cac"),
                   "avg_monthly_subscription", "avg_monthly_take_rate", "avg_monthly_revenue")
    rev = F.col("avg_monthly_revenue")
    cols = [F.col(c) for c in out.columns]
    for n in p.lifetimes:
        cols.append(round_half(rev * F.lit(float(n)), 2).alias(f"avg_ltv_{n}mo"))
    for n in p.lifetimes:
        cols.append(round_half(safe_div(rev * F.lit(float(n)), F.col("cac")), 2).alias(f"ltv_to_cac_{n}mo"))
    return out.select(*cols)


# ----------------------------------------------------------- rpt_funnel_summary
def leads_by_channel(ops_leads: DataFrame) -> DataFrame:
    """Lead-side funnel measures per channel, in two steps.

    First counts and sums per channel and minute of speed-to-lead, then per
    channel, where the median weighs each minute with its count: what one task
    holds of a channel is bounded by the distinct minutes, not by its leads.
    """
    status = F.col("status")
    counts = {
        "total_leads": F.count(F.lit(1)),
        "converted_leads": count_if(F.col("is_converted")),
        "working_leads": count_if(status == L.STATUS_WORKING),
        "new_leads": count_if(status == L.STATUS_NEW),
        "disqualified_leads": count_if(status == L.STATUS_DISQUALIFIED),
        "bad_contact_leads": count_if(status == L.STATUS_BAD_CONTACT),
        "dm_connected_leads": count_if(F.col("connected_with_decision_maker")),
    }
    averaged = {"pred": fn.money("predicted_sales_with_owner"), "touch": F.col("total_touch_count"),
                "location": F.col("location_count")}
    per_minute = ops_leads.groupBy("channel", F.col("speed_to_lead_minutes").alias("minute")).agg(
        *[e.alias(n) for n, e in counts.items()],
        *[F.sum(e).alias(f"{n}_sum") for n, e in averaged.items()],
        *[F.count(e).alias(f"{n}_n") for n, e in averaged.items()],
    )
    minute, n = F.col("minute"), F.col("total_leads")
    return per_minute.groupBy("channel").agg(
        *[F.sum(c).alias(c) for c in counts],
        round_half(exact_mean_of(minute * n, F.when(minute.isNotNull(), n)), 1).alias("avg_speed_to_lead_min"),
        round_half(F.percentile(minute, F.lit(0.5), n), 1).alias("median_speed_to_lead_min"),
        round_half(exact_mean_of("pred_sum", "pred_n"), 0).alias("avg_predicted_sales"),
        round_half(exact_mean_of("touch_sum", "touch_n"), 1).alias("avg_touches_per_lead"),
        round_half(exact_mean_of("location_sum", "location_n"), 1).alias("avg_locations"),
    )


def deals_by_channel(ops_opps: DataFrame) -> DataFrame:
    """Opportunity-side funnel measures per channel (NULL channel is its own group)."""
    won = F.col("is_closed_won")
    loss = F.col("loss_category")
    return ops_opps.groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_opportunities"),
        count_if(won).alias("closed_won"),
        count_if(F.col("is_closed_lost")).alias("closed_lost"),
        count_if(~F.col("is_closed")).alias("open_pipeline"),
        count_if(F.col("demo_held")).alias("demos_held"),
        count_if(loss == L.LOSS_PRE_DEMO).alias("pre_demo_losses"),
        count_if(loss == L.LOSS_PROCESS).alias("process_losses"),
        count_if(loss == L.LOSS_COMPETITIVE).alias("competitive_losses"),
        count_if(loss == L.LOSS_PRODUCT).alias("product_fit_losses"),
        round_half(mean(F.when(won, F.col("days_to_close"))), 1).alias("avg_days_to_close_won"),
        round_half(exact_mean(F.when(won, F.col("predicted_sales_with_owner"))), 0)
        .alias("avg_won_predicted_sales"),
        round_half(mean(F.when(won, F.col("total_touch_count"))), 1).alias("avg_touches_to_win"),
    )


FUNNEL_COLUMNS = [
    "channel", "total_leads", "converted_leads", "lead_to_opp_rate_pct", "total_opportunities", "demos_held",
    "demo_rate_pct", "closed_won", "closed_lost", "open_pipeline", "win_rate_pct", "demo_to_win_rate_pct",
    "lead_to_win_rate_pct", "pre_demo_losses", "process_losses", "competitive_losses", "product_fit_losses",
    "working_leads", "new_leads", "disqualified_leads", "bad_contact_leads", "dm_connected_leads",
    "dm_connection_rate_pct", "avg_speed_to_lead_min", "median_speed_to_lead_min", "avg_predicted_sales",
    "avg_touches_per_lead", "avg_locations", "avg_days_to_close_won", "avg_won_predicted_sales",
    "avg_touches_to_win",
]


def rpt_funnel_summary(ops_leads: DataFrame, ops_opps: DataFrame) -> DataFrame:
    """One row per lead channel: volumes, conversion and win rates, losses, velocity, profile."""
    lm = leads_by_channel(ops_leads)
    om = deals_by_channel(ops_opps)
    # both sides hold one row per channel: the size bound of this broadcast
    j = lm.join(F.broadcast(om), "channel", "left")
    c = F.col
    return j.select(
        *[c(x) for x in ("channel", "total_leads", "converted_leads")],
        pct(c("converted_leads"), c("total_leads")).alias("lead_to_opp_rate_pct"),
        "total_opportunities", "demos_held",
        pct(c("demos_held"), c("total_opportunities")).alias("demo_rate_pct"),
        "closed_won", "closed_lost", "open_pipeline",
        pct(c("closed_won"), c("closed_won") + c("closed_lost")).alias("win_rate_pct"),
        pct(c("closed_won"), c("demos_held")).alias("demo_to_win_rate_pct"),
        pct(c("closed_won"), c("total_leads")).alias("lead_to_win_rate_pct"),
        "pre_demo_losses", "process_losses", "competitive_losses", "product_fit_losses",
        "working_leads", "new_leads", "disqualified_leads", "bad_contact_leads", "dm_connected_leads",
        pct(c("dm_connected_leads"), c("total_leads")).alias("dm_connection_rate_pct"),
        "avg_speed_to_lead_min", "median_speed_to_lead_min", "avg_predicted_sales", "avg_touches_per_lead",
        "avg_locations", "avg_days_to_close_won", "avg_won_predicted_sales", "avg_touches_to_win",
    )


# --------------------------------------------------- rpt_monthly_unit_economics
def monthly_lead_volumes(ops_leads: DataFrame) -> DataFrame:
    """Leads per month and channel, pivoted, in one aggregation.

    Inbound leads count in their form month; outbound leads (no form, by
    definition of the channel) in the month of their first call, first text
    or last activity.  The two cases are disjoint, so one pass replaces the
    UNION ALL of two group-bys and the pivot that follows.
    """
    form = F.col("form_submission_date")
    outbound_anchor = F.coalesce("first_sales_call_date", "first_text_sent_date", "last_sales_activity_date")
    month = F.when(form.isNotNull(), fn.month_start(form)).when(
        F.col("channel") == L.OUTBOUND, fn.month_start(outbound_anchor))
    inbound, outbound = F.col("channel") == L.INBOUND, F.col("channel") == L.OUTBOUND
    conv = F.col("is_converted")
    return (
        ops_leads.select(month.alias("month"), "channel", "is_converted")
        .filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(
            count_if(inbound).alias("inbound_leads"),
            count_if(outbound).alias("outbound_leads"),
            count_if(inbound & conv).alias("inbound_converted"),
            count_if(outbound & conv).alias("outbound_converted"),
        )
    )


def monthly_deal_outcomes(ops_opps: DataFrame) -> DataFrame:
    """Closed deals per close month; a NULL channel counts in neither column."""
    won, lost = F.col("is_closed_won"), F.col("is_closed_lost")
    inbound, outbound = F.col("channel") == L.INBOUND, F.col("channel") == L.OUTBOUND
    revenue = fn.money("predicted_sales_with_owner")
    return (
        ops_opps.filter(F.col("is_closed") & F.col("close_date").isNotNull())
        .groupBy(fn.month_start("close_date").alias("month"))
        .agg(
            count_if(inbound & won).alias("inbound_wins"),
            count_if(outbound & won).alias("outbound_wins"),
            count_if(inbound & lost).alias("inbound_losses"),
            count_if(outbound & lost).alias("outbound_losses"),
            F.sum(F.when(inbound & won, revenue)).alias("_in_revenue"),
            F.sum(F.when(outbound & won, revenue)).alias("_out_revenue"),
        )
    )


MONTHLY_COLUMNS = [
    "expense_month", "advertising_spend", "inbound_sales_team_cost", "outbound_sales_team_cost",
    "inbound_channel_cost", "outbound_channel_cost", "total_gtm_cost", "inbound_leads", "outbound_leads",
    "inbound_converted", "outbound_converted", "inbound_wins", "outbound_wins", "inbound_losses",
    "outbound_losses", "inbound_won_predicted_revenue", "outbound_won_predicted_revenue",
    "inbound_cost_per_lead", "inbound_cost_per_opportunity", "inbound_cac", "outbound_cost_per_lead",
    "outbound_cost_per_opportunity", "outbound_cac", "blended_cac",
]


def rpt_monthly_unit_economics(ops_exp: DataFrame, ops_leads: DataFrame, ops_opps: DataFrame) -> DataFrame:
    """One row per expense month: costs, volumes by channel, unit costs and CAC."""
    leads_m = monthly_lead_volumes(ops_leads)
    opps_m = monthly_deal_outcomes(ops_opps)
    e = ops_exp
    # the monthly frames hold one row per calendar month: at most 12 x 10,000
    # rows (four-digit years), a few MB at worst, whatever the lead volume;
    # that bound is what makes broadcasting them to the expense rows safe
    j = (e.join(F.broadcast(leads_m), e.expense_month == leads_m.month, "left").drop("month")
         .join(F.broadcast(opps_m), e.expense_month == opps_m.month, "left").drop("month"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    rev = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    vol = j.select(
        "expense_month", "advertising_spend", "inbound_sales_team_cost", "outbound_sales_team_cost",
        "inbound_channel_cost", "outbound_channel_cost", "total_gtm_cost",
        *[z(c).alias(c) for c in ("inbound_leads", "outbound_leads", "inbound_converted", "outbound_converted",
                                  "inbound_wins", "outbound_wins", "inbound_losses", "outbound_losses")],
        rev("_in_revenue").alias("inbound_won_predicted_revenue"),
        rev("_out_revenue").alias("outbound_won_predicted_revenue"),
    )
    c = F.col
    return vol.select(
        "*",
        round_half(safe_div(c("inbound_channel_cost"), c("inbound_leads")), 2).alias("inbound_cost_per_lead"),
        round_half(safe_div(c("inbound_channel_cost"), c("inbound_converted")), 2)
        .alias("inbound_cost_per_opportunity"),
        round_half(safe_div(c("inbound_channel_cost"), c("inbound_wins")), 2).alias("inbound_cac"),
        round_half(safe_div(c("outbound_channel_cost"), c("outbound_leads")), 2).alias("outbound_cost_per_lead"),
        round_half(safe_div(c("outbound_channel_cost"), c("outbound_converted")), 2)
        .alias("outbound_cost_per_opportunity"),
        round_half(safe_div(c("outbound_channel_cost"), c("outbound_wins")), 2).alias("outbound_cac"),
        round_half(safe_div(c("total_gtm_cost"), c("inbound_wins") + c("outbound_wins")), 2).alias("blended_cac"),
    ).select(*MONTHLY_COLUMNS)


# ------------------------------------------------------- rpt_channel_efficiency
EFFICIENCY_COLUMNS = [
    "channel", "expense_month", "new_leads", "converted_leads", "deals_won", "deals_lost", "total_channel_cost",
    "monthly_cac", "lead_to_win_rate_pct", "total_monthly_revenue_won", "rolling_3mo_cac",
    "rolling_3mo_conversion_rate", "rolling_3mo_deals_won", "is_full_rolling_window", "cac_mom_delta",
    "cac_mom_pct_change", "conversion_rate_mom_delta", "conversion_rate_mom_pct_change", "deals_won_mom_delta",
    "new_leads_mom_delta", "pct_of_total_spend", "pct_of_total_wins", "pct_of_total_leads",
    "pct_of_total_revenue", "cac_threshold_flag", "conversion_threshold_flag", "cac_trend", "efficiency_score",
]


def _both(prefix_col: str) -> Column:
    """inbound_x + outbound_x with SUM's NULL rule (NULL only if both are)."""
    a, b = F.col(f"inbound_{prefix_col}"), F.col(f"outbound_{prefix_col}")
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def channel_months(monthly: DataFrame) -> DataFrame:
    """rpt_monthly_unit_economics, one row per channel and month (one scan).

    The month totals over both channels are read off the wide monthly row
    before it is unpivoted, so no window or join is needed for them.
    """
    def group(prefix: str) -> dict[str, str]:
        return {
            "new_leads": f"{prefix}_leads",
            "converted_leads": f"{prefix}_converted",
            "deals_won": f"{prefix}_wins",
            "deals_lost": f"{prefix}_losses",
            "total_channel_cost": f"{prefix}_channel_cost",
            "monthly_cac": f"{prefix}_cac",
            "total_monthly_revenue_won": f"{prefix}_won_predicted_revenue",
        }

    totals = {
        "total_spend_all_channels": _both("channel_cost"),
        "total_wins_all_channels": _both("wins"),
        "total_leads_all_channels": _both("leads"),
        "total_revenue_all_channels": _both("won_predicted_revenue"),
    }
    wide = monthly.select("*", *[c.alias(n) for n, c in totals.items()])
    long = unpivot_groups(wide, ["expense_month", *totals], "channel",
                          [(L.INBOUND, group("inbound")), (L.OUTBOUND, group("outbound"))])
    return long.withColumn("lead_to_win_rate_pct", pct(F.col("deals_won"), F.col("converted_leads")))


def rpt_channel_efficiency(monthly: DataFrame, p: Params) -> DataFrame:
    """One row per channel and month: rolling three-row averages, deltas, mix, flags, trend."""
    u = channel_months(monthly)
    w = trailing(["channel"], ["expense_month"], p.rolling_rows)
    w0 = ordered(["channel"], ["expense_month"])
    c = F.col
    r = u.select(
        "*",
        rolling_mean("monthly_cac", w, 2).alias("rolling_3mo_cac"),
        rolling_mean("lead_to_win_rate_pct", w, 2).alias("rolling_3mo_conversion_rate"),
        rolling_mean("deals_won", w, 1).alias("rolling_3mo_deals_won"),
        rolling_count(w).alias("rolling_window_months"),
        F.lag("monthly_cac", 1).over(w0).alias("prev_month_cac"),
        F.lag("lead_to_win_rate_pct", 1).over(w0).alias("prev_month_conversion_rate"),
        F.lag("deals_won", 1).over(w0).alias("prev_month_deals_won"),
        F.lag("new_leads", 1).over(w0).alias("prev_month_new_leads"),
    )
    cac, rate = c("monthly_cac"), c("lead_to_win_rate_pct")
    rolling_cac = c("rolling_3mo_cac")
    return r.select(
        "channel", "expense_month", "new_leads", "converted_leads", "deals_won", "deals_lost",
        "total_channel_cost", "monthly_cac", "lead_to_win_rate_pct", "total_monthly_revenue_won",
        "rolling_3mo_cac", "rolling_3mo_conversion_rate", "rolling_3mo_deals_won",
        (c("rolling_window_months") >= p.rolling_rows).alias("is_full_rolling_window"),
        round_half(cac - c("prev_month_cac"), 2).alias("cac_mom_delta"),
        round_half(safe_div((cac - c("prev_month_cac")) * F.lit(100.0), c("prev_month_cac")), 1)
        .alias("cac_mom_pct_change"),
        round_half(rate - c("prev_month_conversion_rate"), 2).alias("conversion_rate_mom_delta"),
        round_half(safe_div((rate - c("prev_month_conversion_rate")) * F.lit(100.0),
                            c("prev_month_conversion_rate")), 1).alias("conversion_rate_mom_pct_change"),
        (c("deals_won") - c("prev_month_deals_won")).alias("deals_won_mom_delta"),
        (c("new_leads") - c("prev_month_new_leads")).alias("new_leads_mom_delta"),
        pct(c("total_channel_cost"), c("total_spend_all_channels"), 1).alias("pct_of_total_spend"),
        pct(c("deals_won"), c("total_wins_all_channels"), 1).alias("pct_of_total_wins"),
        pct(c("new_leads"), c("total_leads_all_channels"), 1).alias("pct_of_total_leads"),
        pct(c("total_monthly_revenue_won"), c("total_revenue_all_channels"), 1).alias("pct_of_total_revenue"),
        F.when(cac > p.cac_critical, F.lit(L.FLAG_CRITICAL)).when(cac > p.cac_warning, F.lit(L.FLAG_WARNING))
        .otherwise(F.lit(L.FLAG_HEALTHY)).alias("cac_threshold_flag"),
        F.when(rate < p.conversion_critical, F.lit(L.FLAG_CRITICAL)).when(rate < p.conversion_warning, F.lit(L.FLAG_WARNING))
        .otherwise(F.lit(L.FLAG_HEALTHY)).alias("conversion_threshold_flag"),
        F.when(c("rolling_window_months") < p.rolling_rows, F.lit(L.TREND_INSUFFICIENT))
        .when(cac > rolling_cac * F.lit(1.0 + p.trend_band), F.lit(L.TREND_WORSE))
        .when(cac < rolling_cac * F.lit(1.0 - p.trend_band), F.lit(L.TREND_BETTER))
        .otherwise(F.lit(L.TREND_STABLE)).alias("cac_trend"),
        F.when(c("deals_won") == 0, F.lit(None).cast("double"))
        .otherwise(round_half(safe_div(cac, rate) * F.lit(100.0), 2)).alias("efficiency_score"),
    )


# ---------------------------------------------------------- rpt_pipeline_health
SEGMENT_KEYS = ["channel", "record_type", "pipeline_segment", "demo_status", "health_status"]

PIPELINE_REPORT_COLUMNS = SEGMENT_KEYS + [
    "record_count", "pct_of_channel", "total_forecasted_monthly_revenue", "total_forecasted_annual_revenue",
    "avg_forecasted_monthly_revenue", "pct_of_channel_forecasted_revenue", "total_potential_monthly_revenue",
    "total_potential_annual_revenue", "avg_potential_monthly_revenue", "pct_of_channel_potential_revenue",
    "avg_days_in_pipeline", "avg_days_in_current_stage", "min_days_in_pipeline", "max_days_in_pipeline",
    "avg_predicted_sales", "avg_touch_count", "avg_speed_to_lead_minutes", "decision_maker_pct", "demos_held",
    "demos_pending", "high_risk_count", "medium_risk_count", "low_risk_count", "high_risk_pct",
    "medium_risk_pct", "low_risk_pct", "responded_under_5min", "responded_under_30min", "responded_over_1hr",
]


def segment_rollup(pipeline: DataFrame) -> DataFrame:
    """Measures per (channel, record type, segment, demo status, health)."""
    risk, speed = F.col("risk_level"), F.col("speed_to_lead_minutes")
    n = F.count(F.lit(1))
    share = lambda cond: round_half(count_if(cond).cast("double") * F.lit(100.0) / n, 1)
    return pipeline.groupBy(*SEGMENT_KEYS).agg(
        n.alias("record_count"),
        round_half(exact_sum("forecasted_monthly_revenue"), 2).alias("total_forecasted_monthly_revenue"),
        round_half(exact_sum("forecasted_annual_revenue"), 2).alias("total_forecasted_annual_revenue"),
        round_half(exact_mean("forecasted_monthly_revenue"), 2).alias("avg_forecasted_monthly_revenue"),
        round_half(exact_sum("potential_monthly_revenue"), 2).alias("total_potential_monthly_revenue"),
        round_half(exact_sum("potential_annual_revenue"), 2).alias("total_potential_annual_revenue"),
        round_half(exact_mean("potential_monthly_revenue"), 2).alias("avg_potential_monthly_revenue"),
        round_half(mean("days_in_pipeline"), 1).alias("avg_days_in_pipeline"),
        round_half(mean("days_in_current_stage"), 1).alias("avg_days_in_current_stage"),
        F.min("days_in_pipeline").alias("min_days_in_pipeline"),
        F.max("days_in_pipeline").alias("max_days_in_pipeline"),
        round_half(exact_mean("predicted_sales_with_owner"), 2).alias("avg_predicted_sales"),
        round_half(mean("total_touch_count"), 1).alias("avg_touch_count"),
        round_half(mean(speed), 1).alias("avg_speed_to_lead_minutes"),
        share(F.col("connected_with_decision_maker")).alias("decision_maker_pct"),
        count_if(F.col("demo_held")).alias("demos_held"),
        count_if(F.col("demo_set_date").isNotNull() & (F.col("demo_held") == F.lit(False))).alias("demos_pending"),
        count_if(risk == L.RISK_HIGH).alias("high_risk_count"),
        count_if(risk == L.RISK_MEDIUM).alias("medium_risk_count"),
        count_if(risk == L.RISK_LOW).alias("low_risk_count"),
        share(risk == L.RISK_HIGH).alias("high_risk_pct"),
        share(risk == L.RISK_MEDIUM).alias("medium_risk_pct"),
        share(risk == L.RISK_LOW).alias("low_risk_pct"),
        count_if(speed <= 5).alias("responded_under_5min"),
        count_if(speed <= 30).alias("responded_under_30min"),
        count_if(speed > 60).alias("responded_over_1hr"),
    )


def rpt_pipeline_health(pipeline: DataFrame) -> DataFrame:
    """Segment measures with each segment's share of its channel."""
    s = segment_rollup(pipeline)
    # channel totals over the (few) segment rows; a NULL channel gets none,
    # as an equality join on channel would give
    ch = Window.partitionBy("channel")
    has_channel = F.col("channel").isNotNull()
    total_records = F.when(has_channel, F.sum("record_count").over(ch))
    total_fore = F.when(has_channel, F.sum(fn.money("total_forecasted_annual_revenue")).over(ch).cast("double"))
    total_pot = F.when(has_channel, F.sum(fn.money("total_potential_annual_revenue")).over(ch).cast("double"))
    c = F.col
    return s.select(
        *SEGMENT_KEYS, "record_count",
        round_half(c("record_count").cast("double") * F.lit(100.0) / total_records, 1).alias("pct_of_channel"),
        "total_forecasted_monthly_revenue", "total_forecasted_annual_revenue", "avg_forecasted_monthly_revenue",
        pct(c("total_forecasted_annual_revenue"), total_fore, 1).alias("pct_of_channel_forecasted_revenue"),
        "total_potential_monthly_revenue", "total_potential_annual_revenue", "avg_potential_monthly_revenue",
        pct(c("total_potential_annual_revenue"), total_pot, 1).alias("pct_of_channel_potential_revenue"),
        *PIPELINE_REPORT_COLUMNS[15:],
    )


# ---------------------------------------------------- rpt_lead_outreach_priority
OUTREACH_COLUMNS = [
    "lead_id", "outreach_section", "channel", "working_lead_health", "predicted_sales_with_owner",
    "predicted_sales_tier", "form_submission_date", "first_outreach_at", "last_sales_activity_date",
    "minutes_waiting", "hours_waiting", "days_waiting", "speed_to_lead_minutes", "total_touch_count",
    "connected_with_decision_maker", "outreach_priority", "priority_sort_key", "is_actionable",
    "recommended_action", "dashboard_status", "is_high_value_urgent",
]

NO_OUTREACH = L.SECTION_NO_OUTREACH
SLOW_OUTREACH = L.SECTION_SLOW_OUTREACH
NO_OUTREACH_LABELS = {
    "no_anchor": L.NO_OUTREACH_NO_ANCHOR, "p0": L.NO_OUTREACH_P0, "p1": L.NO_OUTREACH_P1,
    "p2": L.NO_OUTREACH_P2, "expired": L.NO_OUTREACH_EXPIRED,
}
SLOW_OUTREACH_LABELS = L.SLOW_OUTREACH


def _no_outreach_label(minutes: Column, p: Params, field: int) -> Column:
    pick = lambda k: F.lit(NO_OUTREACH_LABELS[k][field])
    return (F.when(minutes.isNull(), pick("no_anchor"))
            .when(minutes >= p.outreach_expiry_minutes, pick("expired"))
            .when(minutes < p.outreach_p0_minutes, pick("p0"))
            .when(minutes < p.outreach_p1_minutes, pick("p1"))
            .when(minutes < p.outreach_expiry_minutes, pick("p2"))
            .otherwise(pick("expired")))


def _slow_label(speed: Column, field: int) -> Column:
    expr = None
    for cut, *vals in SLOW_OUTREACH_LABELS:
        v = F.lit(vals[field])
        if cut is None:
            return expr.otherwise(v)
        expr = F.when(speed <= cut, v) if expr is None else expr.when(speed <= cut, v)
    return expr


def without_outreach() -> Column:
    """Leads nobody has called or texted."""
    return F.col("first_sales_call_date").isNull() & F.col("first_text_sent_date").isNull()


def in_outreach_queue() -> Column:
    """Working leads without outreach, or inbound ones with a known wait (over ops_leads)."""
    working = (F.col("status") == L.STATUS_WORKING) & (F.col("is_converted") == F.lit(False))
    slow = ~without_outreach() & (F.col("channel") == L.INBOUND) & F.col("speed_to_lead_minutes").isNotNull()
    return working & (without_outreach() | slow)


def rpt_lead_outreach_priority(ops_leads: DataFrame, p: Params) -> DataFrame:
    """Both sections in one narrow pass (they are disjoint by contact)."""
    as_of_ts = fn.ts_literal(f"{p.as_of} 00:00:00")
    as_of_date = fn.date_literal(p.as_of)
    call, text = F.col("first_sales_call_date"), F.col("first_text_sent_date")
    anchor = F.coalesce(F.col("form_submission_date"), call)
    speed = F.col("speed_to_lead_minutes")
    base = ops_leads.filter(in_outreach_queue()).select(
        "*",
        F.when(without_outreach(), F.lit(NO_OUTREACH)).otherwise(F.lit(SLOW_OUTREACH)).alias("outreach_section"),
        F.least(call, text).alias("first_outreach_at"),
        fn.minute_diff(anchor, as_of_ts).alias("_wait_min"),
        fn.hour_diff(anchor, as_of_ts).alias("_wait_hour"),
        fn.day_diff(anchor, as_of_date).alias("_wait_day"),
    )
    no = F.col("outreach_section") == NO_OUTREACH
    wait = F.col("_wait_min")
    minutes = F.when(no, wait).otherwise(speed)
    hours = F.when(no, F.col("_wait_hour").cast("double")).otherwise(round_half(speed / F.lit(60.0), 1))
    days = F.when(no, F.col("_wait_day").cast("double")).otherwise(round_half(speed / F.lit(1440.0), 1))
    priority = F.when(no, _no_outreach_label(wait, p, 0)).otherwise(_slow_label(speed, 0))
    sort_key = F.when(no, _no_outreach_label(wait, p, 1)).otherwise(_slow_label(speed, 1))
    actionable = F.when(no, wait.isNotNull() & (wait < p.outreach_expiry_minutes)).otherwise(F.lit(True))
    action = F.when(no, _no_outreach_label(wait, p, 2)).otherwise(_slow_label(speed, 2))
    labeled = base.select(
        "lead_id", "outreach_section", "channel", "working_lead_health", "predicted_sales_with_owner",
        "predicted_sales_tier", "form_submission_date", "first_outreach_at", "last_sales_activity_date",
        minutes.cast("bigint").alias("minutes_waiting"), hours.alias("hours_waiting"), days.alias("days_waiting"),
        "speed_to_lead_minutes", "total_touch_count", "connected_with_decision_maker",
        priority.alias("outreach_priority"), sort_key.cast("bigint").alias("priority_sort_key"),
        actionable.alias("is_actionable"), action.alias("recommended_action"),
    )
    sec, pri, act = F.col("outreach_section"), F.col("outreach_priority"), F.col("is_actionable")
    dashboard = (
        F.when(pri == NO_OUTREACH_LABELS["no_anchor"][0], F.lit(L.DASHBOARD_NO_ANCHOR))
        .when((sec == NO_OUTREACH) & (act == F.lit(True)), F.lit(L.DASHBOARD_ACTION))
        .when((sec == NO_OUTREACH) & (act == F.lit(False)), F.lit(L.DASHBOARD_EXPIRED))
        .when((sec == SLOW_OUTREACH) & pri.isin(SLOW_OUTREACH_LABELS[3][1], SLOW_OUTREACH_LABELS[4][1]),
              F.lit(L.DASHBOARD_REENGAGE))
        .when(sec == SLOW_OUTREACH, F.lit(L.DASHBOARD_MONITOR))
        .otherwise(F.lit(L.DASHBOARD_REVIEW))
    )
    urgent = F.when((act == F.lit(True)) & (F.col("predicted_sales_with_owner") >= p.high_value_sales)
                    & (sec == NO_OUTREACH), F.lit(True)).otherwise(F.lit(False))
    return labeled.select("*", dashboard.alias("dashboard_status"), urgent.alias("is_high_value_urgent"))


def outreach_order() -> list[Column]:
    """Queue order: actionable first, section, sort key, value (NULLs last)."""
    return [F.col("is_actionable").desc_nulls_last(), F.col("outreach_section").asc_nulls_last(),
            F.col("priority_sort_key").asc_nulls_last(), F.col("predicted_sales_with_owner").desc_nulls_last(),
            F.col("lead_id").asc()]


def outreach_top(outreach: DataFrame, k: int) -> DataFrame:
    """The first ``k`` leads of the queue (per-partition top-k, then merge)."""
    return outreach.orderBy(*outreach_order()).limit(k)


# report presentation orders (the stored tables carry no order)
PRESENTATION_ORDER = {
    "rpt_cac_ltv_by_channel": ["channel"],
    "rpt_channel_efficiency": ["channel", "expense_month"],
    "rpt_monthly_unit_economics": ["expense_month"],
    "rpt_pipeline_health": SEGMENT_KEYS,
}
