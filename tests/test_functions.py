"""Hand-made edge rows for every cleaning and labelling rule."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from helpers import day, sources, ts
from pipewright import functions as fn
from pipewright.params import DEFAULT as P
from pipewright.plans import Pipeline


def test_minute_diff_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")),
         (ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:59")),
         (ts("2024-01-01 10:00:00"), ts("2024-01-01 09:59:00")),
         (ts("0024-03-01 23:59:59"), ts("0024-03-02 00:00:00"))],
        "a timestamp_ntz, b timestamp_ntz")
    out = df.select(fn.minute_diff("a", "b").alias("m"), fn.hour_diff("a", "b").alias("h"),
                    fn.day_diff("a", "b").alias("d")).collect()
    assert [(r.m, r.h, r.d) for r in out] == [(1, 0, 0), (0, 0, 0), (-1, -1, 0), (1, 1, 1)]


def test_fix_year(spark):
    df = spark.createDataFrame(
        [(ts("0024-03-05 10:20:30"), day("0024-02-29")), (ts("2024-12-31 23:59:59"), day("2023-01-01")),
         (ts("1999-07-01 00:00:00"), day("0999-12-31")), (None, None)],
        "t timestamp_ntz, d date")
    out = df.select(fn.fix_year_ts("t").alias("t"), fn.fix_year_date("d").alias("d")).collect()
    assert [(r.t, r.d) for r in out] == [
        (ts("2024-03-05 10:20:30"), day("2024-02-29")), (ts("2024-12-31 23:59:59"), day("2023-01-01")),
        (ts("2999-07-01 00:00:00"), day("2999-12-31")), (None, None)]


def test_fix_year_keeps_milliseconds_only(spark):
    df = spark.createDataFrame([(dt.datetime(24, 3, 5, 10, 20, 30, 123456),)], "t timestamp_ntz")
    assert df.select(fn.fix_year_ts("t")).first()[0] == dt.datetime(2024, 3, 5, 10, 20, 30, 123000)


@pytest.mark.parametrize("text,expected", [
    ("US$    55 779,40", 55779.4), ("", None), (None, None), ("-5,00", 5.0), ("55779.40", 5577940.0),
    ("1,2,3", None), ("US$ 1 000,5", 1000.5),
])
def test_parse_currency(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(fn.parse_currency("c")).first()[0] == expected


def test_parse_month(spark):
    df = spark.createDataFrame([("Jan-24",), ("Jun-24",)], "m string")
    assert [r[0] for r in df.select(fn.parse_month("m")).collect()] == [day("2024-01-01"), day("2024-06-01")]


def test_parse_month_raises_on_bad_text(spark):
    df = spark.createDataFrame([("not a month",)], "m string")
    with pytest.raises(Exception):
        df.select(fn.parse_month("m")).collect()


@pytest.mark.parametrize("text,expected", [
    ("426,83", 426.83), ("n/a", None), (None, None), ("1d", None), ("", None), ("1.2.3", None), ("12", 12.0),
])
def test_decimal_comma(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(fn.decimal_comma("c")).first()[0] == expected


@pytest.mark.parametrize("text,expected", [
    ("[]", 0), (" [] ", 0), ("", 0), (None, 0), ("[None]", 1), ("['a', 'b']", 2), ('["Wendy\'s"]', 0),
    ("['a'] x", 0), ("{'a': 1}", 0), ("not a list", 0), ("['Thai', 'Pizza', 'BBQ']", 3),
])
def test_list_count(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(fn.list_count("c")).first()[0] == expected


def test_speed_buckets_borders(spark):
    vals = [0, 5, 6, 15, 16, 60, 61, 1440, 1441, 4320, 4321, None]
    df = spark.createDataFrame([(v,) for v in vals], "m bigint")
    got = [r[0] for r in df.select(fn.upper_bucket("m", P.speed_cuts, P.speed_labels, "Not Applicable")).collect()]
    assert got == ["0-5 min", "0-5 min", "5-15 min", "5-15 min", "15-60 min", "15-60 min", "1-24 hours",
                   "1-24 hours", "1-3 days", "1-3 days", "3+ days", "Not Applicable"]


def test_tier_borders(spark):
    vals = [None, -1.0, 0.0, 499.99, 500.0, 1000.0, 2000.0, 5000.0, 10000.0]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r[0] for r in df.select(fn.lower_bucket("p", P.tier_cuts, P.tier_labels, "Unknown")).collect()]
    assert got == ["Unknown", "Tier 6 - Under $500", "Tier 6 - Under $500", "Tier 6 - Under $500",
                   "Tier 5 - $500-1,000", "Tier 4 - $1,000-2,000", "Tier 3 - $2,000-5,000",
                   "Tier 2 - $5,000-10,000", "Tier 1 - $10,000+"]


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.25,), (None,), (0.0,)], "x double")
    assert [r[0] for r in df.select(fn.round_half("x", 0)).collect()][:2] == [3.0, -3.0]
    assert df.select(fn.round_half("x", 1)).collect()[2][0] == 1.3
    assert df.select(fn.round_half("x", 1)).collect()[3][0] is None


def _pipeline(spark, **kw):
    return Pipeline(spark, sources(spark, **kw))


def test_speed_to_lead_guards(spark):
    leads = [
        {"lead_id": "form_only", "form_submission_date": ts("0024-03-01 10:00")},
        {"lead_id": "call_only", "first_sales_call_date": ts("0024-03-01 10:00")},
        {"lead_id": "text_first", "form_submission_date": ts("0024-03-01 10:00"),
         "first_sales_call_date": ts("0024-03-01 11:00"), "first_text_sent_date": ts("0024-03-01 10:07")},
        {"lead_id": "contact_before_form", "form_submission_date": ts("0024-03-01 10:00"),
         "first_sales_call_date": ts("0024-03-01 09:00")},
        {"lead_id": "form_2023", "form_submission_date": ts("0023-12-31 10:00"),
         "first_sales_call_date": ts("0023-12-31 10:05")},
        {"lead_id": "boundary", "form_submission_date": ts("0024-03-01 00:00:59"),
         "first_sales_call_date": ts("0024-03-01 00:01:01")},
    ]
    pl = _pipeline(spark, leads=leads)
    got = {r.lead_id: (r.channel, r.speed_to_lead_minutes)
           for r in pl.entity_leads.select("lead_id", "channel", "speed_to_lead_minutes").collect()}
    assert got == {"form_only": ("Inbound", None), "call_only": ("Outbound", None), "text_first": ("Inbound", 7),
                   "contact_before_form": ("Inbound", None), "form_2023": ("Inbound", None),
                   "boundary": ("Inbound", 1)}


def test_working_lead_health(spark):
    as_of = day(P.as_of)

    def ago(n):
        d = as_of - dt.timedelta(days=n)
        return dt.datetime(d.year - 2000, d.month, d.day)   # source year bug

    leads = [{"lead_id": f"w{n}", "status": "Working", "last_sales_activity_date": ago(n)} for n in (30, 31, 90, 91)]
    leads += [{"lead_id": "no_date", "status": "Working"}, {"lead_id": "new", "status": "New",
                                                           "last_sales_activity_date": ago(200)}]
    pl = _pipeline(spark, leads=leads)
    got = {r.lead_id: (r.working_lead_health, r.days_since_last_activity)
           for r in pl.ops_leads.select("lead_id", "working_lead_health", "days_since_last_activity").collect()}
    assert got == {"w30": ("Active", 30), "w31": ("Aging", 31), "w90": ("Aging", 90), "w91": ("Stale", 91),
                   "no_date": ("Active", None), "new": (None, 200)}


def test_status_normalized_and_counts_zeroed(spark):
    pl = _pipeline(spark, leads=[{"lead_id": "a", "status": "Incorrect_Contact_Data", "sales_call_count": 2}])
    r = pl.ops_leads.first()
    assert r.status == "Incorrect Contact Data"
    assert (r.sales_call_count, r.sales_text_count, r.sales_email_count, r.total_touch_count) == (2, 0, 0, 2)


REASONS = ["Non-Responsive", "Lack of Urgency", "Price", "Lost to Competitor", "POS Integration", "Bad Fit",
           "No Decision / Non-Responsive", None]


def test_loss_category(spark):
    opps = []
    for i, reason in enumerate(REASONS):
        for held in (False, True, None):
            opps.append({"opportunity_id": f"{i}-{held}", "stage_name": "Closed Lost", "lost_reason_c": reason,
                         "demo_held": held, "created_date": ts("2024-03-01 15:00")})
    opps.append({"opportunity_id": "won", "stage_name": "Closed Won", "demo_held": False,
                 "created_date": ts("2024-03-01 15:00")})
    pl = _pipeline(spark, opps=opps)
    got = {r.opportunity_id: r.loss_category for r in pl.ops_opportunities.collect()}
    expected_by_reason = {"Non-Responsive": "Process/Follow-Up Loss", "Lack of Urgency": "Process/Follow-Up Loss",
                          "Price": "Competitive Loss", "Lost to Competitor": "Competitive Loss",
                          "POS Integration": "Product Fit Loss", "Bad Fit": "Product Fit Loss",
                          "No Decision / Non-Responsive": "Other Loss", None: "Other Loss"}
    for i, reason in enumerate(REASONS):
        assert got[f"{i}-False"] == "Pre-Demo Loss"
        assert got[f"{i}-True"] == expected_by_reason[reason]
        assert got[f"{i}-None"] == expected_by_reason[reason]
    assert got["won"] is None


def test_closed_flags_on_null_stage(spark):
    pl = _pipeline(spark, opps=[{"opportunity_id": "x", "stage_name": None, "created_date": ts("2024-03-01 15:00")}])
    r = pl.entity_opportunities.first()
    assert (r.deal_outcome, r.is_closed_won, r.is_closed_lost, r.is_closed) == ("Open", None, None, None)
    # is_closed = FALSE keeps it out of the open pipeline too
    assert pl.ops_pipeline_health.count() == 0


def test_demo_status_and_null_channel(spark):
    base = {"stage_name": "Interest", "created_date": ts("2024-07-01 15:00")}
    opps = [{**base, "opportunity_id": "held", "demo_held": True, "demo_set_date": day("0024-07-02")},
            {**base, "opportunity_id": "not_held", "demo_held": False, "demo_set_date": day("0024-07-02")},
            {**base, "opportunity_id": "unknown", "demo_held": None, "demo_set_date": day("0024-07-02")},
            {**base, "opportunity_id": "none", "demo_held": None}]
    pl = _pipeline(spark, opps=opps)
    got = {r.record_id: (r.demo_status, r.channel, r.potential_monthly_revenue)
           for r in pl.ops_pipeline_health.collect()}
    # no lead -> NULL channel -> default win rate 0.20 on the 500 subscription
    assert got == {"held": ("Demo Held", None, 100.0), "not_held": ("Demo Scheduled - Not Held", None, 100.0),
                   "unknown": ("Unknown", None, 100.0), "none": ("No Demo Scheduled", None, 100.0)}


@pytest.mark.parametrize("minutes,priority,sort_key,actionable,status", [
    (-60, "P0 - Immediate", 1, True, "ACTION REQUIRED"),
    (0, "P0 - Immediate", 1, True, "ACTION REQUIRED"),
    (59, "P0 - Immediate", 1, True, "ACTION REQUIRED"),
    (60, "P1 - Urgent", 2, True, "ACTION REQUIRED"),
    (1439, "P1 - Urgent", 2, True, "ACTION REQUIRED"),
    (1440, "P2 - At Risk", 3, True, "ACTION REQUIRED"),
    (4319, "P2 - At Risk", 3, True, "ACTION REQUIRED"),
    (4320, "Expired", 99, False, "EXPIRED — NURTURE"),
    (None, "Outbound - No Anchor Date", 50, False, "DATA QUALITY — NO ANCHOR"),
])
def test_outreach_priority(spark, minutes, priority, sort_key, actionable, status):
    as_of = dt.datetime(24, 7, 10)
    lead = {"lead_id": "l", "status": "Working", "predicted_sales_with_owner": "6000,00"}
    if minutes is not None:
        lead["form_submission_date"] = as_of - dt.timedelta(minutes=minutes)
    pl = _pipeline(spark, leads=[lead])
    r = pl.rpt_lead_outreach_priority.first()
    assert (r.outreach_section, r.minutes_waiting, r.outreach_priority, r.priority_sort_key, r.is_actionable,
            r.dashboard_status) == ("No Outreach", minutes, priority, sort_key, actionable, status)
    assert r.is_high_value_urgent is actionable


def test_slow_outreach_sections(spark):
    form = dt.datetime(24, 3, 1, 10, 0)
    leads = [{"lead_id": f"s{m}", "status": "Working", "form_submission_date": form,
              "first_sales_call_date": form + dt.timedelta(minutes=m)} for m in (5, 60, 1440, 4320, 4321)]
    leads.append({"lead_id": "outbound_contacted", "status": "Working", "first_sales_call_date": form})
    pl = _pipeline(spark, leads=leads)
    got = {r.lead_id: (r.outreach_priority, r.priority_sort_key, r.hours_waiting, r.dashboard_status)
           for r in pl.rpt_lead_outreach_priority.collect()}
    assert got == {
        "s5": ("On Time (<=5 min)", 10, 0.1, "MONITOR"),
        "s60": ("Slightly Late (5-60 min)", 8, 1.0, "MONITOR"),
        "s1440": ("Late (1-24 hours)", 6, 24.0, "MONITOR"),
        "s4320": ("Very Late (1-3 days)", 4, 72.0, "RE-ENGAGE"),
        "s4321": ("Critically Late (3+ days)", 3, 72.0, "RE-ENGAGE"),
    }


def test_rolling_window_rows_and_null_cac(spark):
    from pipewright.plans import reports
    months = [day(f"2024-0{m}-01") for m in range(1, 5)]
    rows = []
    for i, m in enumerate(months):
        wins = 0 if i == 1 else 10
        rows.append({"expense_month": m, "inbound_leads": 100, "outbound_leads": 50, "inbound_converted": 20,
                     "outbound_converted": 10, "inbound_wins": wins, "outbound_wins": 5, "inbound_losses": 1,
                     "outbound_losses": 1, "inbound_channel_cost": 1000.0 * (i + 1), "outbound_channel_cost": 500.0,
                     "inbound_cac": (1000.0 * (i + 1) / wins) if wins else None, "outbound_cac": 100.0,
                     "inbound_won_predicted_revenue": 10.0, "outbound_won_predicted_revenue": 5.0})
    monthly = spark.createDataFrame(rows)
    out = {r.expense_month: r for r in reports.rpt_channel_efficiency(monthly, P).filter("channel = 'Inbound'")
           .collect()}
    r1, r2, r3, r4 = (out[m] for m in months)
    assert [r.is_full_rolling_window for r in (r1, r2, r3, r4)] == [False, False, True, True]
    assert r2.monthly_cac is None and r2.efficiency_score is None
    assert r2.rolling_3mo_cac == 100.0              # AVG skips the NULL month
    assert r3.rolling_3mo_cac == 200.0              # (100 + 300) / 2
    assert r1.cac_trend == "Insufficient Data" and r3.cac_trend == "Deteriorating"
    assert r3.rolling_3mo_deals_won == 6.7          # (10 + 0 + 10) / 3


def test_null_channel_dropped_by_channel_reports(spark):
    opps = [{"opportunity_id": "o1", "stage_name": "Closed Won", "created_date": ts("2024-03-01 15:00"),
             "close_date": day("0024-03-20")}]
    leads = [{"lead_id": "l1", "status": "Converted", "form_submission_date": ts("0024-02-01 10:00"),
              "converted_opportunity_id": "missing"}]
    ad = [("Mar-24", "US$    1 000,00")]
    pl = _pipeline(spark, leads=leads, opps=opps, ad=ad, sal=[])
    assert pl.ops_opportunities.first().channel is None
    assert pl.rpt_cac_ltv_by_channel.count() == 0          # inner join on channel drops NULL
    funnel = {r.channel: r for r in pl.rpt_funnel_summary.collect()}
    assert set(funnel) == {"Inbound"} and funnel["Inbound"].total_opportunities is None


def test_tolerant_month_opt_in(spark):
    df = spark.createDataFrame([("Jan-24",), ("garbage",)], "m string")
    assert [r[0] for r in df.select(fn.parse_month("m", tolerant=True)).collect()] == [day("2024-01-01"), None]


def test_median_speed_interpolates(spark):
    from pipewright.plans import reports
    leads = spark.createDataFrame(
        [("Inbound", m, False, "Working", None, 1, 1, None) for m in (1, 2, 3, 10, None)] * 3,
        "channel string, speed_to_lead_minutes bigint, is_converted boolean, status string, "
        "connected_with_decision_maker boolean, total_touch_count bigint, location_count bigint, "
        "predicted_sales_with_owner double")
    row = reports.leads_by_channel(leads).first()
    assert row.median_speed_to_lead_min == 2.5      # interpolated, like the warehouse MEDIAN
    assert row.avg_speed_to_lead_min == 4.0 and row.total_leads == 15


def test_money_keeps_all_digits_and_does_not_overflow(spark):
    df = spark.createDataFrame([(1.004,)] * 3, "x double")
    assert tuple(df.agg(fn.exact_sum("x"), fn.exact_mean("x")).first()) == (3.012, 1.004)
    big = spark.createDataFrame([(9.5e14,)] * 200, "x double")
    assert big.agg(fn.exact_sum("x")).first()[0] == 1.9e17


def test_tolerant_numbers(spark):
    df = spark.createDataFrame([("5,",), (" 426,83 ",), ("1e3",), (",5",), ("1e",), ("n/a",), ("",)], "t string")
    assert [r[0] for r in df.select(fn.decimal_comma("t")).collect()] == [5.0, 426.83, 1000.0, 0.5, None, None, None]


def test_list_count_needs_one_whole_list(spark):
    df = spark.createDataFrame([("['a',\n'b']",), ("[1] x [2]",), ("[1],[2]",), ("[1]",), ("{'a': 1}",), ("[None]",)], "t string")
    assert [r[0] for r in df.select(fn.list_count("t")).collect()] == [2, 0, 0, 1, 0, 1]


def test_fix_year_raises_on_impossible_leap_day(spark):
    # 1600 is a leap year, 2600 is not: the rewritten text is not a date
    df = spark.createDataFrame([(ts("1600-02-29 00:00"),)], "t timestamp_ntz")
    with pytest.raises(Exception):
        df.select(fn.fix_year_ts("t")).collect()


def test_amounts_of_twenty_digits_survive_a_sum(spark):
    """Text straight to DECIMAL, in Spark and in the oracle: no DOUBLE between."""
    import duckdb

    from oracle.sqlkit import exact_currency
    from pipewright import functions as fn

    texts = ["US$    12 345 678 901 234 567 890,12", "US$ 0,0000000001", "-5,00", "55779.40", "", None, "no number", "US$ 98 765 432 109 876 543 210,99"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = decimal.Decimal("111111111011116689046.1100000001")
    assert df.agg(F.sum(fn.exact_currency("t"))).first()[0] == want
    values = ", ".join("(NULL)" if t is None else f"('{t}')" for t in texts)
    assert duckdb.sql(f"SELECT SUM({exact_currency('t')}) FROM (VALUES {values}) v(t)").fetchall()[0][0] == want
