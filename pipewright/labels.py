"""Text values the models emit or match on.

Fixed values: every string below must equal the reference's for equal
results (labels written into reports, and source values the rules compare
against).  They are listed plainly, in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------- Fixed values
# channel of a lead (form submitted -> inbound)
INBOUND = "Inbound"
OUTBOUND = "Outbound"

# opportunity stage names matched by the rules
STAGE_CLOSED_WON = "Closed Won"
STAGE_CLOSED_LOST = "Closed Lost"
STAGE_INTEREST = "Interest"
STAGE_DEMO_SET = "Demo Set"
STAGE_IN_PROGRESS = "In Progress"
STAGE_VERBAL = "Verbal Commitment"
STAGE_ON_HOLD = "On Hold"

# deal outcome
WON = "Won"
LOST = "Lost"
OPEN = "Open"

# lead statuses matched by the rules
STATUS_WORKING = "Working"
STATUS_NEW = "New"
STATUS_DISQUALIFIED = "Disqualified"
STATUS_BAD_CONTACT = "Incorrect Contact Data"

# lost reasons matched by the rules
REASON_NO_DEMO = "No Demo Held"

# speed-to-lead buckets and predicted-sales tiers
SPEED_NOT_APPLICABLE = "Not Applicable"
SPEED_LABELS = ("0-5 min", "5-15 min", "15-60 min", "1-24 hours", "1-3 days", "3+ days")
TIER_UNKNOWN = "Unknown"
TIER_LABELS = (
    "Tier 1 - $10,000+",
    "Tier 2 - $5,000-10,000",
    "Tier 3 - $2,000-5,000",
    "Tier 4 - $1,000-2,000",
    "Tier 5 - $500-1,000",
    "Tier 6 - Under $500",
)

# working-lead health
HEALTH_ACTIVE = "Active"
HEALTH_AGING = "Aging"
HEALTH_STALE = "Stale"

# loss categories
LOSS_PRE_DEMO = "Pre-Demo Loss"
LOSS_PROCESS = "Process/Follow-Up Loss"
LOSS_COMPETITIVE = "Competitive Loss"
LOSS_PRODUCT = "Product Fit Loss"
LOSS_OTHER = "Other Loss"

# pipeline health records
RECORD_OPPORTUNITY = "Opportunity"
RECORD_LEAD = "Lead"
SEGMENT_EARLY = "Early Pipeline"
SEGMENT_DEMO = "Demo Scheduled"
SEGMENT_ACTIVE_DEAL = "Active Deal"
SEGMENT_NEAR_CLOSE = "Near Close"
SEGMENT_STALLED = "Stalled"
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

# channel efficiency flags and trend
FLAG_CRITICAL = "Critical"
FLAG_WARNING = "Warning"
FLAG_HEALTHY = "Healthy"
TREND_INSUFFICIENT = "Insufficient Data"
TREND_WORSE = "Deteriorating"
TREND_BETTER = "Improving"
TREND_STABLE = "Stable"

# outreach queue: sections; (priority, sort key, recommended action) of
# leads never contacted, by minutes waiting; of leads contacted late, by
# speed to lead (upper bound in minutes, None = above the last bound)
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
DASHBOARD_REVIEW = "REVIEW"

# exploration buckets (labels carry their sort prefix)
Q_SPEED_LABELS = ("a. 0-5 min", "b. 5-15 min", "c. 15-60 min", "d. 1-24 hours", "e. 1-3 days", "f. 3+ days")
Q_AGE_LABELS = ("a. 0-30 days", "b. 30-60 days", "c. 60-90 days", "d. 90-180 days", "e. 180+ days")
Q_VALUE_LABELS = ("a. $5,000+", "b. $2,000-5,000", "c. $1,000-2,000", "d. $500-1,000", "e. $1-500",
                  "f. Unknown/Zero")
# ------------------------------------------------------------ end fixed values
