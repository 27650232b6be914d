"""Operational tables: ops_leads, ops_opportunities, ops_expenses,
ops_pipeline_health.

Partitioning notes (what the physical plan does at scale):

* ``ops_opportunities`` joins opportunities to one lead per opportunity.  The
  opportunity side is already hash-partitioned on ``opportunity_id`` by its
  own dedupe, and the lead side on ``converted_opportunity_id`` by the
  one-lead-per-opportunity dedupe, so the sort-merge join adds no exchange of
  its own.  NULL keys (the unconverted ~90 % of leads) are filtered out before
  the lead shuffle, so they never meet in one task.
* ``ops_pipeline_health`` is a union of two narrow projections: of the stored
  tables, or of the shared frames (``plans/shared.py``), where both branches read
  the leads from one exchange: a converted lead goes on into the join with its
  opportunity, a working lead is appended as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .. import labels as L
from ..operators import dedupe
from ..params import Params
from .layers import LIST_COLUMNS, ROWS, present


def monthly_revenue(p_col: Column, prm: Params) -> Column:
    """subscription + take rate x predicted sales (NULL sales -> 0)."""
    return F.lit(prm.monthly_subscription) + F.coalesce(p_col * F.lit(prm.take_rate), F.lit(0.0))


def _idle_days(*cols: str, as_of: str) -> Column:
    return fn.day_diff(F.coalesce(*[F.col(c) for c in cols]), fn.date_literal(as_of))


def ops_leads(entity: DataFrame, p: Params) -> DataFrame:
    """One row per lead with speed bucket, sales tier, idle days and working health."""
    idle = _idle_days("last_sales_activity_date", "last_sales_call_date", "last_sales_email_date",
                      "form_submission_date", as_of=p.as_of)
    # no activity date at all -> 'Active' (both comparisons are NULL)
    health = F.when(
        F.col("status") == L.STATUS_WORKING,
        F.when(idle > p.health_stale_days, F.lit(L.HEALTH_STALE))
        .when(idle > p.health_aging_days, F.lit(L.HEALTH_AGING))
        .otherwise(F.lit(L.HEALTH_ACTIVE)),
    )
    return entity.select(
        "lead_id", "converted_opportunity_id", "channel", "status", "is_converted",
        "form_submission_date", "first_sales_call_date", "first_text_sent_date", "first_meeting_booked_date",
        "last_sales_call_date", "last_sales_activity_date", "last_sales_email_date",
        "sales_call_count", "sales_text_count", "sales_email_count", "total_touch_count",
        "speed_to_lead_minutes",
        fn.upper_bucket("speed_to_lead_minutes", p.speed_cuts, p.speed_labels, L.SPEED_NOT_APPLICABLE)
        .alias("speed_to_lead_bucket"),
        "predicted_sales_with_owner",
        fn.lower_bucket("predicted_sales_with_owner", p.tier_cuts, p.tier_labels, L.TIER_UNKNOWN)
        .alias("predicted_sales_tier"),
        "location_count", "connected_with_decision_maker",
        *present(entity, *LIST_COLUMNS),
        idle.alias("days_since_last_activity"),
        health.alias("working_lead_health"),
        *present(entity, ROWS),
    )


def one_lead_per_opportunity(leads: DataFrame) -> DataFrame:
    """Lowest lead_id per converted_opportunity_id; NULL ids dropped first.

    lead_id is unique after the raw dedupe, so the order needs no tie-break.
    """
    return dedupe(leads, "converted_opportunity_id", ["lead_id"], drop_null_keys=True, tie_break=None)


def loss_category(p: Params) -> Column:
    """Why a lost deal was lost; the first matching rule wins."""
    lost, reason = F.col("is_closed_lost"), F.col("lost_reason_c")
    return (
        F.when(lost & (F.col("demo_held") == F.lit(False)), F.lit(L.LOSS_PRE_DEMO))
        .when(lost & reason.isin(*p.loss_process_reasons), F.lit(L.LOSS_PROCESS))
        .when(lost & reason.isin(*p.loss_competitive_reasons), F.lit(L.LOSS_COMPETITIVE))
        .when(lost & reason.isin(*p.loss_product_reasons), F.lit(L.LOSS_PRODUCT))
        .when(lost, F.lit(L.LOSS_OTHER))
    )


# what an opportunity takes from its lead
LEAD_COLUMNS = ["lead_id", "channel", "predicted_sales_with_owner", "predicted_sales_tier", "location_count",
                "connected_with_decision_maker", "total_touch_count", "speed_to_lead_minutes",
                "marketplace_count", "form_submission_date"]


def ops_opportunities(entity_opps: DataFrame, ops_leads_df: DataFrame, p: Params) -> DataFrame:
    """One row per opportunity, enriched with its lead, revenue model and loss category."""
    # project first: only these columns cross the dedupe shuffle
    leads = one_lead_per_opportunity(ops_leads_df.select(*LEAD_COLUMNS, "converted_opportunity_id"))
    return enriched(entity_opps, leads, p)


def enriched(entity_opps: DataFrame, leads: DataFrame, p: Params) -> DataFrame:
    """Opportunities with the one lead each may have in ``leads``."""
    o = entity_opps.alias("o")
    l_ = leads.alias("l")
    joined = o.join(l_, F.col("o.opportunity_id") == F.col("l.converted_opportunity_id"), "left")
    pred = F.col("l.predicted_sales_with_owner")
    return joined.select(
        *[F.col(f"o.{c}") for c in (
            "opportunity_id", "stage_name", "deal_outcome", "lost_reason_c", "closed_lost_notes_c",
            "business_issue_c", "how_did_you_hear_about_us_c", "created_date", "demo_held", "demo_set_date",
            "demo_time", "close_date", "last_sales_call_date_time", "account_id", "days_to_close",
            "days_demo_to_close", "is_closed_won", "is_closed_lost", "is_closed")],
        *[F.col(f"l.{c}") for c in present(leads, *LEAD_COLUMNS) if c != "form_submission_date"],
        F.col("l.form_submission_date").alias("lead_form_submission_date"),
        F.lit(p.monthly_subscription).alias("monthly_subscription"),
        F.coalesce(pred * F.lit(p.take_rate), F.lit(0.0)).alias("monthly_take_rate"),
        monthly_revenue(pred, p).alias("monthly_revenue"),
        loss_category(p).alias("loss_category"),
    )


def ops_expenses(advertising: DataFrame, salary: DataFrame) -> DataFrame:
    """Full outer join of the two monthly ledgers, missing amounts -> 0."""
    a = advertising.alias("a")
    s = salary.alias("s")
    j = a.join(s, F.col("a.expense_month") == F.col("s.expense_month"), "full_outer")
    ad = F.coalesce(F.col("a.advertising_spend"), F.lit(0.0))
    out_team = F.coalesce(F.col("s.outbound_sales_team_cost"), F.lit(0.0))
    in_team = F.coalesce(F.col("s.inbound_sales_team_cost"), F.lit(0.0))
    return j.select(
        F.coalesce(F.col("a.expense_month"), F.col("s.expense_month")).alias("expense_month"),
        ad.alias("advertising_spend"),
        out_team.alias("outbound_sales_team_cost"),
        in_team.alias("inbound_sales_team_cost"),
        (ad + out_team + in_team).alias("total_gtm_cost"),
        (ad + in_team).alias("inbound_channel_cost"),
        out_team.alias("outbound_channel_cost"),
    )


def _channel_rate(inbound: float, outbound: float, other: float) -> Column:
    ch = F.col("channel")
    return F.when(ch == L.INBOUND, F.lit(inbound)).when(ch == L.OUTBOUND, F.lit(outbound)).otherwise(F.lit(other))


PIPELINE_COLUMNS = [
    "record_id", "record_type", "channel", "stage_name", "pipeline_segment", "demo_status", "created_date",
    "demo_set_date", "demo_held", "days_in_pipeline", "days_in_current_stage", "predicted_sales_with_owner",
    "predicted_sales_tier", "forecasted_monthly_revenue", "forecasted_annual_revenue",
    "potential_monthly_revenue", "potential_annual_revenue", "lead_id", "total_touch_count",
    "speed_to_lead_minutes", "connected_with_decision_maker", "health_status", "risk_level",
]


def opportunity_record_columns(p: Params) -> dict[str, Column]:
    """Pipeline columns of an open opportunity (over ops_opportunities columns)."""
    as_of = fn.date_literal(p.as_of)
    stage, held, demo_set = F.col("stage_name"), F.col("demo_held"), F.col("demo_set_date")
    age = fn.day_diff("created_date", as_of)
    win_rate = _channel_rate(p.opp_win_rate_inbound, p.opp_win_rate_outbound, p.opp_win_rate_other)
    revenue = F.col("monthly_revenue")
    return {
        "record_id": F.col("opportunity_id"),
        "record_type": F.lit(L.RECORD_OPPORTUNITY),
        "stage_name": stage,
        "pipeline_segment": fn.lookup(stage, p.stage_segments, L.SEGMENT_OTHER),
        "demo_status": F.when(held == F.lit(True), F.lit(L.DEMO_HELD))
        .when(demo_set.isNotNull() & (held == F.lit(False)), F.lit(L.DEMO_NOT_HELD))
        .when(demo_set.isNull(), F.lit(L.DEMO_NONE))
        .otherwise(F.lit(L.DEMO_UNKNOWN)),
        "created_date": F.col("created_date"),
        "demo_set_date": demo_set,
        "demo_held": held,
        "days_in_pipeline": age,
        "days_in_current_stage": fn.day_diff(F.coalesce(demo_set, F.col("created_date").cast("date")), as_of),
        "forecasted_monthly_revenue": revenue,
        "forecasted_annual_revenue": revenue * F.lit(12.0),
        "potential_monthly_revenue": fn.round_half(revenue * win_rate, 2),
        "potential_annual_revenue": fn.round_half(revenue * F.lit(12.0) * win_rate, 2),
        "health_status": F.when(stage == L.STAGE_ON_HOLD, F.lit(L.OPP_STALLED))
        .when(age > p.health_stale_days, F.lit(L.OPP_AGING))
        .when(age > p.health_aging_days, F.lit(L.OPP_MATURING))
        .otherwise(F.lit(L.OPP_FRESH)),
        "risk_level": F.when(stage == L.STAGE_ON_HOLD, F.lit(L.RISK_HIGH))
        .when((stage == L.STAGE_INTEREST) & (age > p.risk_interest_days), F.lit(L.RISK_HIGH))
        .when((held == F.lit(False)) & demo_set.isNotNull()
              & (fn.day_diff(demo_set, as_of) > p.risk_demo_days), F.lit(L.RISK_HIGH))
        .when(age > p.risk_medium_days, F.lit(L.RISK_MEDIUM))
        .otherwise(F.lit(L.RISK_LOW)),
    }


def lead_record_columns(p: Params) -> dict[str, Column]:
    """Pipeline columns of an unconverted working lead (over ops_leads columns)."""
    as_of = fn.date_literal(p.as_of)
    health = F.col("working_lead_health")
    anchor = F.coalesce(F.col("form_submission_date"), F.col("first_sales_call_date"))
    revenue = monthly_revenue(F.col("predicted_sales_with_owner"), p)
    rate = _channel_rate(p.lead_rate_inbound, p.lead_rate_outbound, p.lead_rate_other)
    return {
        "record_id": F.col("lead_id"),
        "record_type": F.lit(L.RECORD_LEAD),
        "stage_name": F.col("status"),
        "pipeline_segment": F.when(health == L.HEALTH_ACTIVE, F.lit(L.SEGMENT_ACTIVE_LEAD))
        .when(health == L.HEALTH_AGING, F.lit(L.SEGMENT_AGING_LEAD))
        .when(health == L.HEALTH_STALE, F.lit(L.SEGMENT_STALE_LEAD))
        .otherwise(F.lit(L.SEGMENT_WORKING_LEAD)),
        "demo_status": F.lit(L.DEMO_NONE),
        "created_date": anchor,
        "demo_set_date": F.lit(None).cast("date"),
        "demo_held": F.lit(False),
        "days_in_pipeline": fn.day_diff(anchor, as_of),
        "days_in_current_stage": fn.day_diff(F.coalesce(F.col("last_sales_activity_date"), F.col("last_sales_call_date"),
                                                        F.col("first_sales_call_date"), F.col("form_submission_date")),
                                             as_of),
        "forecasted_monthly_revenue": revenue,
        "forecasted_annual_revenue": revenue * F.lit(12.0),
        "potential_monthly_revenue": fn.round_half(revenue * rate, 2),
        "potential_annual_revenue": fn.round_half(revenue * F.lit(12.0) * rate, 2),
        "health_status": health,
        "risk_level": F.when(health == L.HEALTH_STALE, F.lit(L.RISK_HIGH))
        .when(health == L.HEALTH_AGING, F.lit(L.RISK_MEDIUM))
        .otherwise(F.lit(L.RISK_LOW)),
    }


# columns both record kinds carry over unchanged (from the lead)
_SHARED = ("channel", "predicted_sales_with_owner", "predicted_sales_tier", "lead_id", "total_touch_count",
           "speed_to_lead_minutes", "connected_with_decision_maker")


def _project(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.select(*[(cols[c] if c in cols else F.col(c)).alias(c) for c in PIPELINE_COLUMNS])


def open_opportunity_records(ops_opps: DataFrame, p: Params) -> DataFrame:
    return _project(ops_opps.filter(F.col("is_closed") == F.lit(False)), opportunity_record_columns(p))


def is_working_lead() -> Column:
    return (F.col("status") == L.STATUS_WORKING) & (F.col("is_converted") == F.lit(False))


def working_lead_records(ops_leads_df: DataFrame, p: Params) -> DataFrame:
    return _project(ops_leads_df.filter(is_working_lead()), lead_record_columns(p))


def ops_pipeline_health(ops_opps: DataFrame, ops_leads_df: DataFrame, p: Params) -> DataFrame:
    """Open deals and working leads: a union of two filtered projections, which shuffles nothing."""
    return open_opportunity_records(ops_opps, p).unionByName(working_lead_records(ops_leads_df, p))
