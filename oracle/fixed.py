"""Labels, rates and cuts the oracle's SQL holds the results against.

Stated apart from the library's own, so a wrong label or cut there shows.
"""

from __future__ import annotations

# These must equal the reference's for equal results.
INBOUND = "Inbound"
OUTBOUND = "Outbound"
STAGE_CLOSED_WON = "Closed Won"
STAGE_CLOSED_LOST = "Closed Lost"
STAGE_INTEREST = "Interest"
STAGE_ON_HOLD = "On Hold"
WON = "Won"
LOST = "Lost"
OPEN = "Open"
STATUS_WORKING = "Working"
STATUS_NEW = "New"
STATUS_DISQUALIFIED = "Disqualified"
STATUS_BAD_CONTACT = "Incorrect Contact Data"
SPEED_NOT_APPLICABLE = "Not Applicable"
TIER_UNKNOWN = "Unknown"
HEALTH_ACTIVE = "Active"
HEALTH_AGING = "Aging"
HEALTH_STALE = "Stale"
LOSS_PRE_DEMO = "Pre-Demo Loss"
LOSS_PROCESS = "Process/Follow-Up Loss"
LOSS_COMPETITIVE = "Competitive Loss"
LOSS_PRODUCT = "Product Fit Loss"
LOSS_OTHER = "Other Loss"
RECORD_OPPORTUNITY = "Opportunity"
RECORD_LEAD = "Lead"
SEGMENT_OTHER = "Other Open"
SEGMENT_ACTIVE_LEAD = "Active Lead"
SEGMENT_AGING_LEAD = "Aging Lead"
SEGMENT_STALE_LEAD = "Stale Lead"
SEGMENT_WORKING_LEAD = "Working Lead"
DEMO_HELD = "Demo Held"
DEMO_NOT_HELD = "Demo Scheduled - Not Held"
DEMO_NONE = "No Demo Scheduled"
DEMO_UNKNOWN = "Unknown"
OPP_STALLED = "Stalled"
OPP_AGING = "Aging"
OPP_MATURING = "Maturing"
OPP_FRESH = "Fresh"
RISK_HIGH = "High"
RISK_MEDIUM = "Medium"
RISK_LOW = "Low"
FLAG_CRITICAL = "Critical"
FLAG_WARNING = "Warning"
FLAG_HEALTHY = "Healthy"
TREND_INSUFFICIENT = "Insufficient Data"
TREND_WORSE = "Deteriorating"
TREND_BETTER = "Improving"
TREND_STABLE = "Stable"
SECTION_NO_OUTREACH = "No Outreach"
SECTION_SLOW_OUTREACH = "Slow Outreach"
NO_OUTREACH_NO_ANCHOR = ("Outbound - No Anchor Date", 50, "Verify lead source — no entry timestamp available")
NO_OUTREACH_P0 = ("P0 - Immediate", 1, "Call immediately — within golden hour window")
NO_OUTREACH_P1 = ("P1 - Urgent", 2, "Call today — lead is still warm")
NO_OUTREACH_P2 = ("P2 - At Risk", 3, "Attempt contact ASAP — approaching expiry")
NO_OUTREACH_EXPIRED = ("Expired", 99, "Move to nurture campaign — past 72hr window")
SLOW_OUTREACH = (
    (5, "On Time (<=5 min)", 10, "Good response time — continue normal cadence"),
    (60, "Slightly Late (5-60 min)", 8, "Acceptable — ensure consistent follow-up"),
    (1440, "Late (1-24 hours)", 6, "Re-engage with value proposition — trust may have cooled"),
    (4320, "Very Late (1-3 days)", 4, "High-touch re-engagement needed — acknowledge the delay"),
    (None, "Critically Late (3+ days)", 3, "Recovery outreach — lead likely explored competitors"),
)
DASHBOARD_NO_ANCHOR = "DATA QUALITY — NO ANCHOR"
DASHBOARD_ACTION = "ACTION REQUIRED"
DASHBOARD_EXPIRED = "EXPIRED — NURTURE"
DASHBOARD_REENGAGE = "RE-ENGAGE"
DASHBOARD_MONITOR = "MONITOR"

as_of = "2024-07-10"
speed_guard = "2024-01-01 00:00:00"
speed_cuts = (5, 15, 60, 1440, 4320)
speed_labels = ("0-5 min", "5-15 min", "15-60 min", "1-24 hours", "1-3 days", "3+ days")
tier_cuts = (10000, 5000, 2000, 1000, 500)
tier_labels = (
    "Tier 1 - $10,000+",
    "Tier 2 - $5,000-10,000",
    "Tier 3 - $2,000-5,000",
    "Tier 4 - $1,000-2,000",
    "Tier 5 - $500-1,000",
    "Tier 6 - Under $500",
)
health_stale_days = 90
health_aging_days = 30
loss_process_reasons = ("Non-Responsive", "Lack of Urgency")
loss_competitive_reasons = ("Price", "Lost to Competitor")
loss_product_reasons = ("POS Integration", "Bad Fit")
stage_segments = (
    ("Interest", "Early Pipeline"),
    ("Demo Set", "Demo Scheduled"),
    ("In Progress", "Active Deal"),
    ("Verbal Commitment", "Near Close"),
    ("On Hold", "Stalled"),
)
opp_win_rate_inbound = 0.241
opp_win_rate_outbound = 0.171
opp_win_rate_other = 0.2
lead_conv_inbound = 0.182
lead_conv_outbound = 0.047
lead_rate_other = 0.05
risk_interest_days = 30
risk_demo_days = 14
risk_medium_days = 60
lifetimes = (12, 24, 36)
rolling_rows = 3
cac_critical = 3000.0
cac_warning = 2000.0
conversion_critical = 10.0
conversion_warning = 15.0
trend_band = 0.2
outreach_expiry_minutes = 4320
outreach_p0_minutes = 60
outreach_p1_minutes = 1440
high_value_sales = 5000.0
followup_reasons = ("No Decision / Non-Responsive", "Lack of Urgency")
snapshot_gap_days = 30
# end fixed values
