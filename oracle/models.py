"""The model chain as DuckDB SQL (one CTE per model), written from the
model definitions, independent of the Spark code except for the adapter
formulas that give the test data its shape, and numeric conventions (sqlkit)."""

from __future__ import annotations

from pipewright.sources import adapter as A

from . import fixed as V
from .sqlkit import (currency, ddiff, dec, decimal_comma, emean, esum, fix_date, fix_ts, from_dec, hdiff, list_count, mdiff,
                     mean, month, pct, rnd, sdiv)

AS_OF = f"DATE '{V.as_of}'"
AS_OF_TS = f"TIMESTAMP '{V.as_of} 00:00:00'"
T = A.DUCKDB_TYPES


def _f(template: str) -> str:
    return A.render(template, T)


def _lead_select() -> str:
    return ", ".join(f"{_f(t)} AS {n}" for n, t in A.LEAD_FORMULAS)


def _opp_select(version: int) -> str:
    out = []
    for n, t in A.OPPORTUNITY_FORMULAS:
        sql = _f(t)
        if version == 1 and n == "stage_name":
            sql = A.OLDER_VERSION_STAGE
        if version == 1 and n == "created_date":
            sql = _f(A.OLDER_VERSION_CREATED)
        if version == 2 and n == "created_date":
            sql = "CAST(NULL AS TIMESTAMP)"
        out.append(f"{sql} AS {n}")
    return ", ".join(out)


LEAD_TS = ["form_submission_date", "first_sales_call_date", "first_text_sent_date", "first_meeting_booked_date",
           "last_sales_call_date", "last_sales_activity_date", "last_sales_email_date"]

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


# ------------------------------------------------------------------ sources
cte("z_orders", [], "SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS p FROM orders")
cte("src_leads", ["z_orders"],
    f"SELECT {_lead_select()} FROM z_orders UNION ALL "
    f"SELECT {_lead_select()} FROM z_orders WHERE {A.LEAD_DUPLICATE_RULE}")
cte("z_customers", [], f"SELECT {A.OPPORTUNITY_KEY} AS k, c_custkey AS c FROM customer")
cte("src_opportunities", ["z_customers"],
    f"SELECT {_opp_select(0)} FROM z_customers UNION ALL "
    f"SELECT {_opp_select(1)} FROM z_customers WHERE {A.OPPORTUNITY_OLDER_VERSION_RULE} UNION ALL "
    f"SELECT {_opp_select(2)} FROM z_customers WHERE {A.OPPORTUNITY_NULL_VERSION_RULE}")
cte("z_month_adv", ["z_orders"],
    f"SELECT {A.ADVERTISING_BUCKET} AS b, {A.ADVERTISING_CENTS} AS a0 FROM z_orders GROUP BY 1")
cte("z_month_sal", ["z_orders"],
    f"SELECT {A.SALARY_BUCKET} AS b, {A.OUTBOUND_CENTS} AS a0, {A.INBOUND_CENTS} AS a1 FROM z_orders GROUP BY 1")
_adv_row = (f"SELECT {A.MONTH_TEXT} AS month, CASE WHEN {A.ADVERTISING_NULL_MONTH} THEN CAST(NULL AS VARCHAR)"
            f" ELSE {A.money_text_sql('a0', 'duckdb')} END AS advertising FROM z_month_adv")
cte("src_expenses_advertising", ["z_month_adv"],
    f"{_adv_row} UNION ALL {_adv_row} WHERE {A.ADVERTISING_DUPLICATE}")
_sal_row = (f"SELECT {A.MONTH_TEXT} AS month, {A.money_text_sql('a0', 'duckdb')} AS outbound_sales_team,"
            f" {A.money_text_sql('a1', 'duckdb')} AS inbound_sales_team FROM z_month_sal")
cte("src_expenses_salary", ["z_month_sal"],
    f"{_sal_row} UNION ALL {_sal_row} WHERE {A.SALARY_DUPLICATE}")

# ---------------------------------------------------------------------- raw
cte("raw_leads", ["src_leads"],
    "SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lead_id ORDER BY lead_id) AS _rn"
    " FROM src_leads) WHERE _rn = 1")
cte("raw_opportunities", ["src_opportunities"],
    "SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY opportunity_id"
    " ORDER BY created_date DESC NULLS FIRST) AS _rn FROM src_opportunities) WHERE _rn = 1")
cte("raw_expenses_advertising", ["src_expenses_advertising"],
    "SELECT DISTINCT month, advertising FROM src_expenses_advertising")
cte("raw_expenses_salary", ["src_expenses_salary"],
    "SELECT DISTINCT month, outbound_sales_team, inbound_sales_team FROM src_expenses_salary")

# ------------------------------------------------------------------ staging
cte("stg_leads", ["raw_leads"], "SELECT lead_id, " + ", ".join(f"{fix_ts(c)} AS {c}" for c in LEAD_TS) + ", "
    "CAST(COALESCE(sales_call_count, 0) AS BIGINT) AS sales_call_count, "
    "CAST(COALESCE(sales_text_count, 0) AS BIGINT) AS sales_text_count, "
    "CAST(COALESCE(sales_email_count, 0) AS BIGINT) AS sales_email_count, "
    f"{decimal_comma('predicted_sales_with_owner')} AS predicted_sales_with_owner, "
    f"{list_count('marketplaces_used')} AS marketplace_count, marketplaces_used AS marketplaces_used_raw, "
    f"{list_count('online_ordering_used')} AS online_ordering_count, online_ordering_used AS online_ordering_used_raw, "
    f"{list_count('cuisine_types')} AS cuisine_type_count, cuisine_types AS cuisine_types_raw, "
    "CAST(location_count AS BIGINT) AS location_count, connected_with_decision_maker, "
    "replace(status, '_', ' ') AS status, converted_opportunity_id FROM raw_leads")
cte("stg_opportunities", ["raw_opportunities"],
    "SELECT opportunity_id, stage_name, lost_reason_c, closed_lost_notes_c, business_issue_c, "
    f"how_did_you_hear_about_us_c, {fix_ts('created_date')} AS created_date, demo_held, "
    f"{fix_date('demo_set_date')} AS demo_set_date, {fix_ts('demo_time')} AS demo_time, "
    f"{fix_date('close_date')} AS close_date, {fix_ts('last_sales_call_date_time')} AS last_sales_call_date_time, "
    "account_id FROM raw_opportunities")
cte("stg_expenses_advertising", ["raw_expenses_advertising"],
    f"SELECT CAST(strptime(month, '%b-%y') AS DATE) AS expense_month, {currency('advertising')} AS advertising_spend"
    " FROM raw_expenses_advertising")
cte("stg_expenses_salary", ["raw_expenses_salary"],
    "SELECT CAST(strptime(month, '%b-%y') AS DATE) AS expense_month, "
    f"{currency('outbound_sales_team')} AS outbound_sales_team_cost, "
    f"{currency('inbound_sales_team')} AS inbound_sales_team_cost FROM raw_expenses_salary")

# ------------------------------------------------------------------- entity
def _v(text: str) -> str:
    """A label as a SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


# first contact: DuckDB's least() skips NULLs
_FC = "least(first_sales_call_date, first_text_sent_date)"
cte("entity_leads", ["stg_leads"],
    "WITH t AS (SELECT *, least(first_sales_call_date, first_text_sent_date) AS touch FROM stg_leads) "
    "SELECT lead_id, " + ", ".join(LEAD_TS) + ", sales_call_count, sales_text_count, sales_email_count, "
    "sales_call_count + sales_text_count + sales_email_count AS total_touch_count, predicted_sales_with_owner, "
    "marketplace_count, marketplaces_used_raw, online_ordering_count, online_ordering_used_raw, cuisine_type_count, "
    "cuisine_types_raw, location_count, connected_with_decision_maker, status, converted_opportunity_id, "
    f"if(form_submission_date IS NULL, {_v(V.OUTBOUND)}, {_v(V.INBOUND)}) AS channel, "
    f"if(form_submission_date >= TIMESTAMP '{V.speed_guard}' AND touch >= form_submission_date, "
    f"{mdiff('form_submission_date', 'touch')}, NULL) AS speed_to_lead_minutes, "
    "converted_opportunity_id IS NOT NULL AS is_converted FROM t")
cte("entity_opportunities", ["stg_opportunities"],
    f"SELECT opportunity_id, stage_name, CASE stage_name WHEN {_v(V.STAGE_CLOSED_WON)} THEN {_v(V.WON)} "
    f"WHEN {_v(V.STAGE_CLOSED_LOST)} THEN {_v(V.LOST)} ELSE {_v(V.OPEN)} END AS deal_outcome, lost_reason_c, "
    "closed_lost_notes_c, business_issue_c, how_did_you_hear_about_us_c, created_date, demo_held, demo_set_date, "
    "demo_time, close_date, last_sales_call_date_time, "
    # a day difference with a NULL side is NULL already
    f"{ddiff('created_date', 'close_date')} AS days_to_close, {ddiff('created_date', 'demo_set_date')} AS days_to_demo, "
    f"{ddiff('demo_set_date', 'close_date')} AS days_demo_to_close, "
    f"stage_name = {_v(V.STAGE_CLOSED_WON)} AS is_closed_won, stage_name = {_v(V.STAGE_CLOSED_LOST)} AS is_closed_lost, "
    f"stage_name IN ({_v(V.STAGE_CLOSED_WON)}, {_v(V.STAGE_CLOSED_LOST)}) AS is_closed, account_id "
    "FROM stg_opportunities")

# -------------------------------------------------------------- operational
_speed_case = (f"CASE WHEN speed_to_lead_minutes IS NULL THEN {_v(V.SPEED_NOT_APPLICABLE)} "
               + " ".join(f"WHEN speed_to_lead_minutes <= {c} THEN {_v(lab)}" for c, lab in zip(V.speed_cuts, V.speed_labels))
               + f" ELSE {_v(V.speed_labels[-1])} END")
_tier_case = (f"CASE WHEN predicted_sales_with_owner IS NULL THEN {_v(V.TIER_UNKNOWN)} "
              + " ".join(f"WHEN predicted_sales_with_owner >= {c} THEN {_v(lab)}" for c, lab in zip(V.tier_cuts, V.tier_labels))
              + f" ELSE {_v(V.tier_labels[-1])} END")
cte("ops_leads", ["entity_leads"],
    "WITH t AS (SELECT *, "
    f"{ddiff('coalesce(last_sales_activity_date, last_sales_call_date, last_sales_email_date, form_submission_date)', AS_OF)}"
    " AS idle FROM entity_leads) "
    "SELECT lead_id, converted_opportunity_id, channel, status, is_converted, " + ", ".join(LEAD_TS) + ", "
    "sales_call_count, sales_text_count, sales_email_count, total_touch_count, speed_to_lead_minutes, "
    f"{_speed_case} AS speed_to_lead_bucket, predicted_sales_with_owner, {_tier_case} AS predicted_sales_tier, "
    "location_count, connected_with_decision_maker, marketplace_count, marketplaces_used_raw, online_ordering_count, "
    "online_ordering_used_raw, cuisine_type_count, cuisine_types_raw, idle AS days_since_last_activity, "
    f"if(status = {_v(V.STATUS_WORKING)}, CASE WHEN idle > {V.health_stale_days} THEN {_v(V.HEALTH_STALE)} "
    f"WHEN idle > {V.health_aging_days} THEN {_v(V.HEALTH_AGING)} ELSE {_v(V.HEALTH_ACTIVE)} END, NULL)"
    " AS working_lead_health FROM t")

def _in_list(values) -> str:
    return ", ".join(_v(v) for v in values)


# loss category: first matching rule wins (reasons and labels from the shared tables)
_LOSS_CASE = (
    f"CASE WHEN o.is_closed_lost THEN CASE WHEN o.demo_held = FALSE THEN {_v(V.LOSS_PRE_DEMO)} "
    f"WHEN o.lost_reason_c IN ({_in_list(V.loss_process_reasons)}) THEN {_v(V.LOSS_PROCESS)} "
    f"WHEN o.lost_reason_c IN ({_in_list(V.loss_competitive_reasons)}) THEN {_v(V.LOSS_COMPETITIVE)} "
    f"WHEN o.lost_reason_c IN ({_in_list(V.loss_product_reasons)}) THEN {_v(V.LOSS_PRODUCT)} "
    f"ELSE {_v(V.LOSS_OTHER)} END END")
# stage -> pipeline segment, as a lookup over the shared pairs
_SEGMENT_CASE = ("CASE stage_name " + " ".join(f"WHEN {_v(a)} THEN {_v(b)}" for a, b in V.stage_segments)
                 + f" ELSE {_v(V.SEGMENT_OTHER)} END")

_REV = "(500.0::DOUBLE + COALESCE(l.predicted_sales_with_owner * 0.05::DOUBLE, 0.0::DOUBLE))"
cte("ops_opportunities", ["entity_opportunities", "ops_leads"],
    "SELECT o.opportunity_id, o.stage_name, o.deal_outcome, o.lost_reason_c, o.closed_lost_notes_c, "
    "o.business_issue_c, o.how_did_you_hear_about_us_c, o.created_date, o.demo_held, o.demo_set_date, o.demo_time, "
    "o.close_date, o.last_sales_call_date_time, o.account_id, o.days_to_close, o.days_demo_to_close, "
    "o.is_closed_won, o.is_closed_lost, o.is_closed, l.lead_id, l.channel, l.predicted_sales_with_owner, "
    "l.predicted_sales_tier, l.location_count, l.connected_with_decision_maker, l.total_touch_count, "
    "l.speed_to_lead_minutes, l.marketplace_count, l.form_submission_date AS lead_form_submission_date, "
    "500.0::DOUBLE AS monthly_subscription, "
    "COALESCE(l.predicted_sales_with_owner * 0.05::DOUBLE, 0.0::DOUBLE) AS monthly_take_rate, "
    f"{_REV} AS monthly_revenue, "
    f"{_LOSS_CASE} AS loss_category "
    "FROM entity_opportunities o LEFT JOIN ("
    "SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY converted_opportunity_id "
    "ORDER BY lead_id) AS _rn FROM ops_leads) WHERE _rn = 1 AND converted_opportunity_id IS NOT NULL"
    ") l ON l.converted_opportunity_id = o.opportunity_id")
cte("ops_expenses", ["stg_expenses_advertising", "stg_expenses_salary"],
    "SELECT COALESCE(a.expense_month, s.expense_month) AS expense_month, "
    "COALESCE(a.advertising_spend, 0.0::DOUBLE) AS advertising_spend, "
    "COALESCE(s.outbound_sales_team_cost, 0.0::DOUBLE) AS outbound_sales_team_cost, "
    "COALESCE(s.inbound_sales_team_cost, 0.0::DOUBLE) AS inbound_sales_team_cost, "
    "COALESCE(a.advertising_spend, 0.0::DOUBLE) + COALESCE(s.outbound_sales_team_cost, 0.0::DOUBLE)"
    " + COALESCE(s.inbound_sales_team_cost, 0.0::DOUBLE) AS total_gtm_cost, "
    "COALESCE(a.advertising_spend, 0.0::DOUBLE) + COALESCE(s.inbound_sales_team_cost, 0.0::DOUBLE)"
    " AS inbound_channel_cost, "
    "COALESCE(s.outbound_sales_team_cost, 0.0::DOUBLE) AS outbound_channel_cost "
    "FROM stg_expenses_advertising a FULL OUTER JOIN stg_expenses_salary s ON a.expense_month = s.expense_month")

def _by_channel(inbound: str, outbound: str, other: str) -> str:
    return f"CASE channel WHEN {_v(V.INBOUND)} THEN {inbound} WHEN {_v(V.OUTBOUND)} THEN {outbound} ELSE {other} END"


_ORATE = _by_channel(f"{V.opp_win_rate_inbound}::DOUBLE", f"{V.opp_win_rate_outbound}::DOUBLE",
                     f"{V.opp_win_rate_other}::DOUBLE")
_LRATE = _by_channel(f"{V.lead_conv_inbound}::DOUBLE * {V.opp_win_rate_inbound}::DOUBLE",
                     f"{V.lead_conv_outbound}::DOUBLE * {V.opp_win_rate_outbound}::DOUBLE",
                     f"{V.lead_rate_other}::DOUBLE")
_LREV = "(500.0::DOUBLE + COALESCE(predicted_sales_with_owner * 0.05::DOUBLE, 0.0::DOUBLE))"
_LANCHOR = "coalesce(form_submission_date, first_sales_call_date)"
_opp_branch = (
    f"SELECT opportunity_id AS record_id, {_v(V.RECORD_OPPORTUNITY)} AS record_type, channel, stage_name, "
    f"{_SEGMENT_CASE} AS pipeline_segment, "
    f"CASE WHEN demo_held THEN {_v(V.DEMO_HELD)} WHEN demo_set_date IS NULL THEN {_v(V.DEMO_NONE)} "
    f"WHEN NOT demo_held THEN {_v(V.DEMO_NOT_HELD)} ELSE {_v(V.DEMO_UNKNOWN)} END AS demo_status, "
    "created_date, demo_set_date, demo_held, age AS days_in_pipeline, "
    f"{ddiff('coalesce(demo_set_date, CAST(created_date AS DATE))', AS_OF)} AS days_in_current_stage, "
    "predicted_sales_with_owner, predicted_sales_tier, monthly_revenue AS forecasted_monthly_revenue, "
    "monthly_revenue * 12.0::DOUBLE AS forecasted_annual_revenue, "
    f"{rnd(f'monthly_revenue * ({_ORATE})', 2)} AS potential_monthly_revenue, "
    f"{rnd(f'monthly_revenue * 12.0::DOUBLE * ({_ORATE})', 2)} AS potential_annual_revenue, "
    "lead_id, total_touch_count, speed_to_lead_minutes, connected_with_decision_maker, "
    f"CASE WHEN stage_name = {_v(V.STAGE_ON_HOLD)} THEN {_v(V.OPP_STALLED)} "
    f"WHEN age > {V.health_stale_days} THEN {_v(V.OPP_AGING)} WHEN age > {V.health_aging_days} THEN {_v(V.OPP_MATURING)} "
    f"ELSE {_v(V.OPP_FRESH)} END AS health_status, "
    f"CASE WHEN stage_name = {_v(V.STAGE_ON_HOLD)} "
    f"OR (stage_name = {_v(V.STAGE_INTEREST)} AND age > {V.risk_interest_days}) "
    f"OR (NOT demo_held AND {ddiff('demo_set_date', AS_OF)} > {V.risk_demo_days}) THEN {_v(V.RISK_HIGH)} "
    f"WHEN age > {V.risk_medium_days} THEN {_v(V.RISK_MEDIUM)} ELSE {_v(V.RISK_LOW)} END AS risk_level "
    f"FROM (SELECT *, {ddiff('created_date', AS_OF)} AS age FROM ops_opportunities WHERE is_closed = FALSE)")
_lead_branch = (
    f"SELECT lead_id AS record_id, {_v(V.RECORD_LEAD)} AS record_type, channel, status AS stage_name, "
    f"CASE working_lead_health WHEN {_v(V.HEALTH_ACTIVE)} THEN {_v(V.SEGMENT_ACTIVE_LEAD)} "
    f"WHEN {_v(V.HEALTH_AGING)} THEN {_v(V.SEGMENT_AGING_LEAD)} WHEN {_v(V.HEALTH_STALE)} THEN {_v(V.SEGMENT_STALE_LEAD)} "
    f"ELSE {_v(V.SEGMENT_WORKING_LEAD)} END AS pipeline_segment, {_v(V.DEMO_NONE)} AS demo_status, "
    f"{_LANCHOR} AS created_date, CAST(NULL AS DATE) AS demo_set_date, FALSE AS demo_held, "
    f"{ddiff(_LANCHOR, AS_OF)} AS days_in_pipeline, "
    f"{ddiff('coalesce(last_sales_activity_date, last_sales_call_date, first_sales_call_date, form_submission_date)', AS_OF)}"
    " AS days_in_current_stage, predicted_sales_with_owner, predicted_sales_tier, "
    f"{_LREV} AS forecasted_monthly_revenue, {_LREV} * 12.0::DOUBLE AS forecasted_annual_revenue, "
    f"{rnd(f'{_LREV} * ({_LRATE})', 2)} AS potential_monthly_revenue, "
    f"{rnd(f'{_LREV} * 12.0::DOUBLE * ({_LRATE})', 2)} AS potential_annual_revenue, "
    "lead_id, total_touch_count, speed_to_lead_minutes, connected_with_decision_maker, "
    "working_lead_health AS health_status, "
    f"CASE working_lead_health WHEN {_v(V.HEALTH_STALE)} THEN {_v(V.RISK_HIGH)} "
    f"WHEN {_v(V.HEALTH_AGING)} THEN {_v(V.RISK_MEDIUM)} ELSE {_v(V.RISK_LOW)} END AS risk_level "
    f"FROM ops_leads WHERE status = {_v(V.STATUS_WORKING)} AND NOT is_converted")
cte("ops_pipeline_health", ["ops_opportunities", "ops_leads"], f"{_opp_branch} UNION ALL {_lead_branch}")

# ---------------------------------------------------------------- reporting
# Written in DuckDB's own idiom (FILTER aggregates, VALUES unpivots, window
# totals), checking the Spark formulations from a different angle.
_IN, _OUT = _v(V.INBOUND), _v(V.OUTBOUND)


def _cnt(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


cte("rpt_cac_ltv_by_channel", ["ops_opportunities", "ops_expenses"],
    "WITH wins AS (SELECT channel, COUNT(*) AS deals_won, "
    f"{rnd(emean('monthly_subscription'), 2)} AS avg_monthly_subscription, "
    f"{rnd(emean('monthly_take_rate'), 2)} AS avg_monthly_take_rate, "
    f"{rnd(emean('monthly_revenue'), 2)} AS avg_monthly_revenue "
    "FROM ops_opportunities WHERE is_closed_won GROUP BY channel), "
    f"spend AS (SELECT ch.channel, CASE ch.channel WHEN {_IN} THEN t.inb ELSE t.outb END AS total_cost FROM "
    f"(SELECT {esum('inbound_channel_cost')} AS inb, {esum('outbound_channel_cost')} AS outb FROM ops_expenses) t, "
    f"(VALUES ({_IN}), ({_OUT})) ch(channel)), "
    "base AS (SELECT w.*, s.total_cost AS total_cost_6mo, "
    f"{rnd('s.total_cost / w.deals_won', 2)} AS cac FROM wins w JOIN spend s USING (channel)) "
    "SELECT channel, deals_won, total_cost_6mo, cac, avg_monthly_subscription, avg_monthly_take_rate, "
    "avg_monthly_revenue, "
    + ", ".join(f"{rnd(f'avg_monthly_revenue * {float(n)}::DOUBLE', 2)} AS avg_ltv_{n}mo" for n in V.lifetimes) + ", "
    + ", ".join(f"{rnd(sdiv(f'avg_monthly_revenue * {float(n)}::DOUBLE', 'cac'), 2)} AS ltv_to_cac_{n}mo"
                for n in V.lifetimes)
    + " FROM base")

_LOSS = {"pre_demo_losses": V.LOSS_PRE_DEMO, "process_losses": V.LOSS_PROCESS,
         "competitive_losses": V.LOSS_COMPETITIVE, "product_fit_losses": V.LOSS_PRODUCT}
cte("rpt_funnel_summary", ["ops_leads", "ops_opportunities"],
    "WITH lead_side AS (SELECT channel, COUNT(*) AS total_leads, "
    f"{_cnt('is_converted')} AS converted_leads, {_cnt('status = ' + _v(V.STATUS_WORKING))} AS working_leads, "
    f"{_cnt('status = ' + _v(V.STATUS_NEW))} AS new_leads, "
    f"{_cnt('status = ' + _v(V.STATUS_DISQUALIFIED))} AS disqualified_leads, "
    f"{_cnt('status = ' + _v(V.STATUS_BAD_CONTACT))} AS bad_contact_leads, "
    f"{_cnt('connected_with_decision_maker')} AS dm_connected_leads, "
    f"{rnd(mean('speed_to_lead_minutes'), 1)} AS avg_speed_to_lead_min, "
    f"{rnd('quantile_cont(speed_to_lead_minutes, 0.5)', 1)} AS median_speed_to_lead_min, "
    f"{rnd(emean('predicted_sales_with_owner'), 0)} AS avg_predicted_sales, "
    f"{rnd(mean('total_touch_count'), 1)} AS avg_touches_per_lead, "
    f"{rnd(mean('location_count'), 1)} AS avg_locations FROM ops_leads GROUP BY channel), "
    "deal_side AS (SELECT channel, COUNT(*) AS total_opportunities, "
    f"{_cnt('is_closed_won')} AS closed_won, {_cnt('is_closed_lost')} AS closed_lost, "
    f"{_cnt('NOT is_closed')} AS open_pipeline, {_cnt('demo_held')} AS demos_held, "
    + ", ".join(f"{_cnt('loss_category = ' + _v(v))} AS {k}" for k, v in _LOSS.items()) + ", "
    f"{rnd('AVG(days_to_close) FILTER (WHERE is_closed_won)', 1)} AS avg_days_to_close_won, "
    f"{rnd(emean('CASE WHEN is_closed_won THEN predicted_sales_with_owner END'), 0)}"
    " AS avg_won_predicted_sales, "
    f"{rnd('CAST(SUM(total_touch_count) FILTER (WHERE is_closed_won) AS DOUBLE) / NULLIF(COUNT(total_touch_count) FILTER (WHERE is_closed_won), 0)', 1)}"
    " AS avg_touches_to_win FROM ops_opportunities GROUP BY channel) "
    "SELECT channel, total_leads, converted_leads, "
    f"{pct('converted_leads', 'total_leads')} AS lead_to_opp_rate_pct, total_opportunities, demos_held, "
    f"{pct('demos_held', 'total_opportunities')} AS demo_rate_pct, closed_won, closed_lost, open_pipeline, "
    f"{pct('closed_won', 'closed_won + closed_lost')} AS win_rate_pct, "
    f"{pct('closed_won', 'demos_held')} AS demo_to_win_rate_pct, "
    f"{pct('closed_won', 'total_leads')} AS lead_to_win_rate_pct, pre_demo_losses, process_losses, "
    "competitive_losses, product_fit_losses, working_leads, new_leads, disqualified_leads, bad_contact_leads, "
    f"dm_connected_leads, {pct('dm_connected_leads', 'total_leads')} AS dm_connection_rate_pct, "
    "avg_speed_to_lead_min, median_speed_to_lead_min, avg_predicted_sales, avg_touches_per_lead, avg_locations, "
    "avg_days_to_close_won, avg_won_predicted_sales, avg_touches_to_win "
    "FROM lead_side LEFT JOIN deal_side USING (channel)")

_ANCHOR = "COALESCE(first_sales_call_date, first_text_sent_date, last_sales_activity_date)"
_VOL = ("inbound_leads", "outbound_leads", "inbound_converted", "outbound_converted", "inbound_wins",
        "outbound_wins", "inbound_losses", "outbound_losses")
cte("rpt_monthly_unit_economics", ["ops_expenses", "ops_leads", "ops_opportunities"],
    f"WITH lead_rows AS (SELECT {month('form_submission_date')} AS m, channel, is_converted FROM ops_leads "
    "WHERE form_submission_date IS NOT NULL "
    f"UNION ALL SELECT {month(_ANCHOR)}, channel, is_converted FROM ops_leads "
    f"WHERE channel = {_OUT} AND {_ANCHOR} IS NOT NULL), "
    f"lead_months AS (SELECT m, {_cnt('channel = ' + _IN)} AS inbound_leads, {_cnt('channel = ' + _OUT)} AS outbound_leads, "
    f"{_cnt('channel = ' + _IN + ' AND is_converted')} AS inbound_converted, "
    f"{_cnt('channel = ' + _OUT + ' AND is_converted')} AS outbound_converted FROM lead_rows GROUP BY m), "
    f"deal_months AS (SELECT {month('close_date')} AS m, "
    f"{_cnt('channel = ' + _IN + ' AND is_closed_won')} AS inbound_wins, "
    f"{_cnt('channel = ' + _OUT + ' AND is_closed_won')} AS outbound_wins, "
    f"{_cnt('channel = ' + _IN + ' AND is_closed_lost')} AS inbound_losses, "
    f"{_cnt('channel = ' + _OUT + ' AND is_closed_lost')} AS outbound_losses, "
    f"{esum(f'CASE WHEN channel = {_IN} AND is_closed_won THEN predicted_sales_with_owner END')} AS in_revenue, "
    f"{esum(f'CASE WHEN channel = {_OUT} AND is_closed_won THEN predicted_sales_with_owner END')} AS out_revenue "
    "FROM ops_opportunities WHERE is_closed AND close_date IS NOT NULL GROUP BY 1), "
    "vol AS (SELECT e.*, "
    + ", ".join(f"CAST(COALESCE({c}, 0) AS BIGINT) AS {c}" for c in _VOL) + ", "
    "COALESCE(in_revenue, 0.0::DOUBLE) AS inbound_won_predicted_revenue, "
    "COALESCE(out_revenue, 0.0::DOUBLE) AS outbound_won_predicted_revenue "
    "FROM ops_expenses e LEFT JOIN lead_months l ON e.expense_month = l.m "
    "LEFT JOIN deal_months d ON e.expense_month = d.m) "
    "SELECT expense_month, advertising_spend, inbound_sales_team_cost, outbound_sales_team_cost, "
    "inbound_channel_cost, outbound_channel_cost, total_gtm_cost, " + ", ".join(_VOL) + ", "
    "inbound_won_predicted_revenue, outbound_won_predicted_revenue, "
    + ", ".join(f"{rnd(sdiv(f'{side}_channel_cost', den), 2)} AS {side}_{name}"
                for side in ("inbound", "outbound")
                for name, den in (("cost_per_lead", f"{side}_leads"), ("cost_per_opportunity", f"{side}_converted"),
                                  ("cac", f"{side}_wins"))) + ", "
    f"{rnd(sdiv('total_gtm_cost', 'inbound_wins + outbound_wins'), 2)} AS blended_cac FROM vol")

_W3 = "(PARTITION BY channel ORDER BY expense_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
_W1 = "(PARTITION BY channel ORDER BY expense_month)"
_WM = "(PARTITION BY expense_month)"


def _roll(col: str, d: int) -> str:
    return rnd(f"{from_dec(f'SUM({dec(col)}) OVER {_W3}')} / NULLIF(COUNT({col}) OVER {_W3}, 0)", d)


def _pick(col: str) -> str:
    return f"CASE ch.channel WHEN {_IN} THEN m.inbound_{col} ELSE m.outbound_{col} END"


cte("rpt_channel_efficiency", ["rpt_monthly_unit_economics"],
    "WITH per_channel AS (SELECT m.expense_month, ch.channel, "
    f"{_pick('leads')} AS new_leads, {_pick('converted')} AS converted_leads, {_pick('wins')} AS deals_won, "
    f"{_pick('losses')} AS deals_lost, {_pick('channel_cost')} AS total_channel_cost, {_pick('cac')} AS monthly_cac, "
    f"{_pick('won_predicted_revenue')} AS total_monthly_revenue_won, "
    f"{pct(_pick('wins'), _pick('converted'))} AS lead_to_win_rate_pct "
    f"FROM rpt_monthly_unit_economics m CROSS JOIN (VALUES ({_IN}), ({_OUT})) ch(channel)), "
    f"framed AS (SELECT *, {_roll('monthly_cac', 2)} AS rolling_3mo_cac, "
    f"{_roll('lead_to_win_rate_pct', 2)} AS rolling_3mo_conversion_rate, "
    f"{_roll('deals_won', 1)} AS rolling_3mo_deals_won, CAST(COUNT(*) OVER {_W3} AS BIGINT) AS n_frame, "
    f"LAG(monthly_cac) OVER {_W1} AS cac_before, LAG(lead_to_win_rate_pct) OVER {_W1} AS rate_before, "
    f"LAG(deals_won) OVER {_W1} AS wins_before, LAG(new_leads) OVER {_W1} AS leads_before, "
    f"SUM(total_channel_cost) OVER {_WM} AS month_spend, SUM(deals_won) OVER {_WM} AS month_wins, "
    f"SUM(new_leads) OVER {_WM} AS month_leads, SUM(total_monthly_revenue_won) OVER {_WM} AS month_revenue "
    "FROM per_channel) "
    "SELECT channel, expense_month, new_leads, converted_leads, deals_won, deals_lost, total_channel_cost, "
    "monthly_cac, lead_to_win_rate_pct, total_monthly_revenue_won, rolling_3mo_cac, rolling_3mo_conversion_rate, "
    f"rolling_3mo_deals_won, n_frame >= {V.rolling_rows} AS is_full_rolling_window, "
    f"{rnd('monthly_cac - cac_before', 2)} AS cac_mom_delta, "
    f"{rnd(sdiv('(monthly_cac - cac_before) * 100.0::DOUBLE', 'cac_before'), 1)} AS cac_mom_pct_change, "
    f"{rnd('lead_to_win_rate_pct - rate_before', 2)} AS conversion_rate_mom_delta, "
    f"{rnd(sdiv('(lead_to_win_rate_pct - rate_before) * 100.0::DOUBLE', 'rate_before'), 1)}"
    " AS conversion_rate_mom_pct_change, "
    "CAST(deals_won - wins_before AS BIGINT) AS deals_won_mom_delta, "
    "CAST(new_leads - leads_before AS BIGINT) AS new_leads_mom_delta, "
    f"{pct('total_channel_cost', 'month_spend', 1)} AS pct_of_total_spend, "
    f"{pct('deals_won', 'month_wins', 1)} AS pct_of_total_wins, "
    f"{pct('new_leads', 'month_leads', 1)} AS pct_of_total_leads, "
    f"{pct('total_monthly_revenue_won', 'month_revenue', 1)} AS pct_of_total_revenue, "
    f"CASE WHEN monthly_cac > {V.cac_critical} THEN {_v(V.FLAG_CRITICAL)} WHEN monthly_cac > {V.cac_warning} "
    f"THEN {_v(V.FLAG_WARNING)} ELSE {_v(V.FLAG_HEALTHY)} END AS cac_threshold_flag, "
    f"CASE WHEN lead_to_win_rate_pct < {V.conversion_critical} THEN {_v(V.FLAG_CRITICAL)} "
    f"WHEN lead_to_win_rate_pct < {V.conversion_warning} THEN {_v(V.FLAG_WARNING)} ELSE {_v(V.FLAG_HEALTHY)} END"
    " AS conversion_threshold_flag, "
    f"CASE WHEN n_frame < {V.rolling_rows} THEN {_v(V.TREND_INSUFFICIENT)} "
    f"WHEN monthly_cac > rolling_3mo_cac * {1.0 + V.trend_band!r}::DOUBLE THEN {_v(V.TREND_WORSE)} "
    f"WHEN monthly_cac < rolling_3mo_cac * {1.0 - V.trend_band!r}::DOUBLE THEN {_v(V.TREND_BETTER)} "
    f"ELSE {_v(V.TREND_STABLE)} END AS cac_trend, "
    f"CASE WHEN deals_won <> 0 THEN {rnd(sdiv('monthly_cac', 'lead_to_win_rate_pct') + ' * 100.0::DOUBLE', 2)} END"
    " AS efficiency_score FROM framed")

_K5 = "channel, record_type, pipeline_segment, demo_status, health_status"


def _share(cond: str) -> str:
    """Percent of the group's rows matching ``cond``, one decimal."""
    return rnd(f"CAST({_cnt(cond)} AS DOUBLE) * 100.0::DOUBLE / COUNT(*)", 1)


_RISKS = ((V.RISK_HIGH, "high"), (V.RISK_MEDIUM, "medium"), (V.RISK_LOW, "low"))
cte("rpt_pipeline_health", ["ops_pipeline_health"],
    f"WITH seg AS (SELECT {_K5}, COUNT(*) AS record_count, "
    f"{rnd(esum('forecasted_monthly_revenue'), 2)} AS total_forecasted_monthly_revenue, "
    f"{rnd(esum('forecasted_annual_revenue'), 2)} AS total_forecasted_annual_revenue, "
    f"{rnd(emean('forecasted_monthly_revenue'), 2)} AS avg_forecasted_monthly_revenue, "
    f"{rnd(esum('potential_monthly_revenue'), 2)} AS total_potential_monthly_revenue, "
    f"{rnd(esum('potential_annual_revenue'), 2)} AS total_potential_annual_revenue, "
    f"{rnd(emean('potential_monthly_revenue'), 2)} AS avg_potential_monthly_revenue, "
    f"{rnd(mean('days_in_pipeline'), 1)} AS avg_days_in_pipeline, "
    f"{rnd(mean('days_in_current_stage'), 1)} AS avg_days_in_current_stage, "
    "MIN(days_in_pipeline) AS min_days_in_pipeline, MAX(days_in_pipeline) AS max_days_in_pipeline, "
    f"{rnd(emean('predicted_sales_with_owner'), 2)} AS avg_predicted_sales, "
    f"{rnd(mean('total_touch_count'), 1)} AS avg_touch_count, "
    f"{rnd(mean('speed_to_lead_minutes'), 1)} AS avg_speed_to_lead_minutes, "
    f"{_share('connected_with_decision_maker')} AS decision_maker_pct, "
    f"{_cnt('demo_held')} AS demos_held, {_cnt('demo_set_date IS NOT NULL AND NOT demo_held')} AS demos_pending, "
    + ", ".join(f"{_cnt('risk_level = ' + _v(v))} AS {n}_risk_count" for v, n in _RISKS) + ", "
    + ", ".join(f"{_share('risk_level = ' + _v(v))} AS {n}_risk_pct" for v, n in _RISKS) + ", "
    f"{_cnt('speed_to_lead_minutes <= 5')} AS responded_under_5min, "
    f"{_cnt('speed_to_lead_minutes <= 30')} AS responded_under_30min, "
    f"{_cnt('speed_to_lead_minutes > 60')} AS responded_over_1hr FROM ops_pipeline_health GROUP BY {_K5}), "
    "per_channel AS (SELECT channel, SUM(record_count) AS n_all, "
    f"{esum('total_forecasted_annual_revenue')} AS fore_all, "
    f"{esum('total_potential_annual_revenue')} AS pot_all FROM seg WHERE channel IS NOT NULL GROUP BY channel) "
    "SELECT seg.channel, record_type, pipeline_segment, demo_status, health_status, record_count, "
    f"{rnd('CAST(record_count AS DOUBLE) * 100.0::DOUBLE / n_all', 1)} AS pct_of_channel, "
    "total_forecasted_monthly_revenue, total_forecasted_annual_revenue, avg_forecasted_monthly_revenue, "
    f"{pct('total_forecasted_annual_revenue', 'fore_all', 1)} AS pct_of_channel_forecasted_revenue, "
    "total_potential_monthly_revenue, total_potential_annual_revenue, avg_potential_monthly_revenue, "
    f"{pct('total_potential_annual_revenue', 'pot_all', 1)} AS pct_of_channel_potential_revenue, "
    "avg_days_in_pipeline, avg_days_in_current_stage, min_days_in_pipeline, max_days_in_pipeline, "
    "avg_predicted_sales, avg_touch_count, avg_speed_to_lead_minutes, decision_maker_pct, demos_held, "
    "demos_pending, high_risk_count, medium_risk_count, low_risk_count, high_risk_pct, medium_risk_pct, "
    "low_risk_pct, responded_under_5min, responded_under_30min, responded_over_1hr "
    "FROM seg LEFT JOIN per_channel pc ON seg.channel = pc.channel")


def _outreach_queue() -> str:
    S = "speed_to_lead_minutes"
    W = "wait_min"
    no_case = (
        f"CASE WHEN {W} IS NULL THEN {{0}} WHEN {W} >= {V.outreach_expiry_minutes} THEN {{4}} "
        f"WHEN {W} < {V.outreach_p0_minutes} THEN {{1}} WHEN {W} < {V.outreach_p1_minutes} THEN {{2}} "
        f"WHEN {W} < {V.outreach_expiry_minutes} THEN {{3}} ELSE {{4}} END")
    rows = (V.NO_OUTREACH_NO_ANCHOR, V.NO_OUTREACH_P0, V.NO_OUTREACH_P1, V.NO_OUTREACH_P2, V.NO_OUTREACH_EXPIRED)

    def no_field(i: int) -> str:
        vals = [(_v(r[i]) if isinstance(r[i], str) else str(r[i])) for r in rows]
        return no_case.format(*vals)

    def slow_field(i: int) -> str:
        parts = []
        for cut, *vals in V.SLOW_OUTREACH:
            v = _v(vals[i]) if isinstance(vals[i], str) else str(vals[i])
            parts.append(f"WHEN {S} <= {cut} THEN {v}" if cut is not None else f"ELSE {v}")
        return "CASE " + " ".join(parts) + " END"

    late = ", ".join(_v(r[1]) for r in V.SLOW_OUTREACH[3:])
    anc = "COALESCE(form_submission_date, first_sales_call_date)"
    return (
        "WITH cand AS (SELECT *, first_sales_call_date IS NULL AND first_text_sent_date IS NULL AS untouched, "
        f"{mdiff(anc, AS_OF_TS)} AS wait_min, {hdiff(anc, AS_OF_TS)} AS wait_hour, {ddiff(anc, AS_OF)} AS wait_day "
        f"FROM ops_leads WHERE status = {_v(V.STATUS_WORKING)} AND NOT is_converted), "
        "queue AS (SELECT lead_id, CASE WHEN untouched THEN "
        f"{_v(V.SECTION_NO_OUTREACH)} ELSE {_v(V.SECTION_SLOW_OUTREACH)} END AS outreach_section, channel, "
        "working_lead_health, predicted_sales_with_owner, predicted_sales_tier, form_submission_date, "
        f"{_FC} AS first_outreach_at, last_sales_activity_date, "
        f"CASE WHEN untouched THEN wait_min ELSE {S} END AS minutes_waiting, "
        f"CASE WHEN untouched THEN CAST(wait_hour AS DOUBLE) ELSE {rnd(f'CAST({S} AS DOUBLE) / 60.0::DOUBLE', 1)} END"
        " AS hours_waiting, "
        f"CASE WHEN untouched THEN CAST(wait_day AS DOUBLE) ELSE {rnd(f'CAST({S} AS DOUBLE) / 1440.0::DOUBLE', 1)} END"
        f" AS days_waiting, {S}, total_touch_count, connected_with_decision_maker, "
        f"CASE WHEN untouched THEN {no_field(0)} ELSE {slow_field(0)} END AS outreach_priority, "
        f"CAST(CASE WHEN untouched THEN {no_field(1)} ELSE {slow_field(1)} END AS BIGINT) AS priority_sort_key, "
        f"CASE WHEN untouched THEN coalesce(wait_min < {V.outreach_expiry_minutes}, FALSE) ELSE TRUE END"
        " AS is_actionable, "
        f"CASE WHEN untouched THEN {no_field(2)} ELSE {slow_field(2)} END AS recommended_action "
        f"FROM cand WHERE untouched OR (channel = {_IN} AND {S} IS NOT NULL)) "
        "SELECT *, "
        f"CASE WHEN outreach_priority = {_v(V.NO_OUTREACH_NO_ANCHOR[0])} THEN {_v(V.DASHBOARD_NO_ANCHOR)} "
        f"WHEN outreach_section = {_v(V.SECTION_NO_OUTREACH)} AND is_actionable THEN {_v(V.DASHBOARD_ACTION)} "
        f"WHEN outreach_section = {_v(V.SECTION_NO_OUTREACH)} THEN {_v(V.DASHBOARD_EXPIRED)} "
        f"WHEN outreach_priority IN ({late}) THEN {_v(V.DASHBOARD_REENGAGE)} "
        f"ELSE {_v(V.DASHBOARD_MONITOR)} END AS dashboard_status, "
        f"coalesce(is_actionable AND predicted_sales_with_owner >= {V.high_value_sales} "
        f"AND outreach_section = {_v(V.SECTION_NO_OUTREACH)}, FALSE) AS is_high_value_urgent FROM queue")


cte("rpt_lead_outreach_priority", ["ops_leads"], _outreach_queue())


def compose(final_sql: str, deps: list[str]) -> str:
    """``WITH`` every CTE ``final_sql`` needs (transitively), in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final_sql
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][1]})" for n in order) + " " + final_sql
