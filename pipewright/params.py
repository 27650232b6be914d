"""Run parameters of the revenue-funnel pipeline.

Every constant the models use lives here, so a run can move the as-of date,
the thresholds or the revenue model without touching any model code.
"""

from __future__ import annotations

from dataclasses import dataclass

from . import labels as L


@dataclass(frozen=True)
class Params:
    # ------------------------------------------------------------------
    # These must equal the reference's for equal results.
    # ------------------------------------------------------------------
    # dataset end date used by every "days since" / "minutes waiting" column
    as_of: str = "2024-07-10"
    # speed-to-lead is only computed for forms on or after this timestamp
    speed_guard: str = "2024-01-01 00:00:00"
    # revenue model: monthly subscription and take rate on predicted sales
    monthly_subscription: float = 500.0
    take_rate: float = 0.05
    # LTV horizons in months
    lifetimes: tuple[int, ...] = (12, 24, 36)
    # historical win rate of an open opportunity by channel, else default
    opp_win_rate_inbound: float = 0.241
    opp_win_rate_outbound: float = 0.171
    opp_win_rate_other: float = 0.20
    # lead conversion rate x win rate by channel, else default
    lead_conv_inbound: float = 0.182
    lead_conv_outbound: float = 0.047
    lead_rate_other: float = 0.05
    # speed-to-lead buckets (upper bounds, minutes, inclusive)
    speed_cuts: tuple[int, ...] = (5, 15, 60, 1440, 4320)
    speed_labels: tuple[str, ...] = L.SPEED_LABELS
    # predicted-sales tiers (lower bounds, inclusive)
    tier_cuts: tuple[int, ...] = (10000, 5000, 2000, 1000, 500)
    tier_labels: tuple[str, ...] = L.TIER_LABELS
    # working-lead health: days since last activity
    health_aging_days: int = 30
    health_stale_days: int = 90
    # opportunity risk cuts (days)
    risk_interest_days: int = 30
    risk_demo_days: int = 14
    risk_medium_days: int = 60
    # outreach priority cuts (minutes waiting)
    outreach_p0_minutes: int = 60
    outreach_p1_minutes: int = 1440
    outreach_expiry_minutes: int = 4320
    high_value_sales: float = 5000.0
    # channel efficiency flags
    cac_warning: float = 2000.0
    cac_critical: float = 3000.0
    conversion_warning: float = 15.0
    conversion_critical: float = 10.0
    trend_band: float = 0.2
    rolling_rows: int = 3
    # loss categories: first matching rule wins
    loss_process_reasons: tuple[str, ...] = ("Non-Responsive", "Lack of Urgency")
    loss_competitive_reasons: tuple[str, ...] = ("Price", "Lost to Competitor")
    loss_product_reasons: tuple[str, ...] = ("POS Integration", "Bad Fit")
    # lost reasons the follow-up analysis looks at
    followup_reasons: tuple[str, ...] = ("No Decision / Non-Responsive", "Lack of Urgency")
    # opportunity stage -> pipeline segment
    stage_segments: tuple[tuple[str, str], ...] = (
        (L.STAGE_INTEREST, L.SEGMENT_EARLY),
        (L.STAGE_DEMO_SET, L.SEGMENT_DEMO),
        (L.STAGE_IN_PROGRESS, L.SEGMENT_ACTIVE_DEAL),
        (L.STAGE_VERBAL, L.SEGMENT_NEAR_CLOSE),
        (L.STAGE_ON_HOLD, L.SEGMENT_STALLED),
    )
    # opt-in (off by default, never silent): NULL instead of an error for
    # month text that does not parse
    tolerant_months: bool = False
    # snapshot diff: the earlier run is this many days before as_of
    snapshot_gap_days: int = 30

    @property
    def lead_rate_inbound(self) -> float:
        return self.lead_conv_inbound * self.opp_win_rate_inbound

    @property
    def lead_rate_outbound(self) -> float:
        return self.lead_conv_outbound * self.opp_win_rate_outbound


DEFAULT = Params()
