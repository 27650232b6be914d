"""View layers: ingress -> raw -> staging -> entity.

Each function takes and returns a lazy DataFrame, so Catalyst sees a single
plan from the Parquet scan to whatever table is finally materialized: column
pruning and filter push-down cross every layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .. import labels as L
from ..operators import dedupe, first_rows
from ..params import Params
from ..sources import schemas

LEAD_TIMESTAMPS = [
    "form_submission_date", "first_sales_call_date", "first_text_sent_date",
    "first_meeting_booked_date", "last_sales_call_date", "last_sales_activity_date",
    "last_sales_email_date",
]
LEAD_LISTS = ("marketplaces_used", "online_ordering_used", "cuisine_types")
LIST_COUNTS = ("marketplace_count", "online_ordering_count", "cuisine_type_count")
# in the models' column order
LIST_COLUMNS = [c for count, text in zip(LIST_COUNTS, LEAD_LISTS, strict=True) for c in (count, f"{text}_raw")]
# how many source rows a shared row stands for (plans/shared.py)
ROWS = "_rows"
# the raw row, carried beside its staging and entity columns (plans/store.py)
RAW = "_raw"


def present(df: DataFrame, *names: str) -> list[str]:
    """Those of the columns that ``df`` has: shared frames lack the lists, and some carry more."""
    return [c for c in names if c in df.columns]


# ---------------------------------------------------------------- ingress
def ingress(df: DataFrame, schema, keep_position: bool = False) -> DataFrame:
    """Column-pruned projection of a source table (plus the row position,
    when asked and present, for the raw dedupes)."""
    extra = list(schemas.POSITION) if keep_position and schemas.has_position(df) else []
    return df.select(*[f.name for f in schema.fields], *extra)


def _dedupe_by_position(df: DataFrame, key: str, order) -> DataFrame:
    """Dedupe whose ties go to the first row in source order.

    The position is a property of the input files, so every query (and every
    retry) picks the same row while reading only the columns it needs.
    Inputs without a position (hand-made frames) break ties by content hash.
    """
    if schemas.has_position(df):
        pos = [F.col(c).asc() for c in schemas.POSITION]
        out = dedupe(df, key, list(order) + pos, tie_break=None)
        return out.drop(*schemas.POSITION)
    return dedupe(df, key, order)


# -------------------------------------------------------------------- raw
def raw_leads(ingress_leads: DataFrame) -> DataFrame:
    """One row per lead_id (exact duplicates removed, deterministic tie)."""
    return _dedupe_by_position(ingress_leads, "lead_id", [F.col("lead_id").asc_nulls_first()])


def raw_opportunities(ingress_opps: DataFrame) -> DataFrame:
    """Latest version per opportunity_id: created_date DESC, NULL first."""
    return _dedupe_by_position(ingress_opps, "opportunity_id", [F.col("created_date").desc_nulls_first()])


def raw_expenses(ingress_expenses: DataFrame) -> DataFrame:
    """Exact duplicate rows removed (SELECT DISTINCT)."""
    return ingress_expenses.distinct()


def shared_rows(ingress_df: DataFrame, key: str, newest: str | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """The raw rows of a source, with how many source rows each key has, for several readers.

    The rows :func:`raw_leads` and (``newest``: the version column) :func:`raw_opportunities`
    keep, without the columns ``without``; see :func:`first_rows`.
    """
    columns = [c for c in ingress_df.columns if c != key and c not in schemas.POSITION]
    if schemas.has_position(ingress_df):
        ties = [F.col(c) for c in schemas.POSITION]
    else:
        ties = [F.xxhash64(*[F.col(c) for c in columns])]
    kept = [c for c in columns if c not in without]
    if newest is None:
        return first_rows(ingress_df, key, ties, kept, ROWS)
    # the largest of (no version date, version date); ties, complemented, to the first position
    order = [F.col(newest).isNull(), F.col(newest), *[F.bitwise_not(t) for t in ties]]
    return first_rows(ingress_df, key, order, kept, ROWS, last=True)


def ledger_rows(ingress_expenses: DataFrame) -> DataFrame:
    """:func:`raw_expenses` with how many source rows each row stands for."""
    return ingress_expenses.groupBy(*ingress_expenses.columns).agg(F.count(F.lit(1)).alias(ROWS)).where(F.col(ROWS) > 0)


# ---------------------------------------------------------------- staging
def stg_leads(raw: DataFrame) -> DataFrame:
    """Leads cleaned column by column (1:1 with raw)."""
    cols = [F.col("lead_id")]
    cols += [fn.fix_year_ts(c).alias(c) for c in LEAD_TIMESTAMPS]
    cols += [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
             for c in ("sales_call_count", "sales_text_count", "sales_email_count")]
    cols.append(fn.decimal_comma("predicted_sales_with_owner").alias("predicted_sales_with_owner"))
    for src, count_name in zip(LEAD_LISTS, LIST_COUNTS, strict=True):
        if src in raw.columns:
            cols.append(fn.list_count(src).alias(count_name))
            cols.append(F.col(src).alias(f"{src}_raw"))
    cols += [
        F.col("location_count"),
        F.col("connected_with_decision_maker"),
        fn.normalize_status("status").alias("status"),
        F.col("converted_opportunity_id"),
        *present(raw, ROWS, RAW),
    ]
    return raw.select(*cols)


def stg_opportunities(raw: DataFrame) -> DataFrame:
    """Opportunities with year-fixed dates (1:1 with raw)."""
    return raw.select(
        "opportunity_id", "stage_name", "lost_reason_c", "closed_lost_notes_c", "business_issue_c",
        "how_did_you_hear_about_us_c",
        fn.fix_year_ts("created_date").alias("created_date"),
        "demo_held",
        fn.fix_year_date("demo_set_date").alias("demo_set_date"),
        fn.fix_year_ts("demo_time").alias("demo_time"),
        fn.fix_year_date("close_date").alias("close_date"),
        fn.fix_year_ts("last_sales_call_date_time").alias("last_sales_call_date_time"),
        "account_id", *present(raw, ROWS, RAW),
    )


def stg_expenses_advertising(raw: DataFrame, tolerant_months: bool = False) -> DataFrame:
    """Advertising ledger: month as DATE, amount as DOUBLE."""
    return raw.select(
        fn.parse_month("month", tolerant_months).alias("expense_month"),
        fn.parse_currency("advertising").alias("advertising_spend"), *present(raw, RAW),
    )


def stg_expenses_salary(raw: DataFrame, tolerant_months: bool = False) -> DataFrame:
    """Sales-team ledger: month as DATE, both team amounts as DOUBLE."""
    return raw.select(
        fn.parse_month("month", tolerant_months).alias("expense_month"),
        fn.parse_currency("outbound_sales_team").alias("outbound_sales_team_cost"),
        fn.parse_currency("inbound_sales_team").alias("inbound_sales_team_cost"), *present(raw, RAW),
    )


# ----------------------------------------------------------------- entity
def first_contact() -> F.Column:
    """Earliest of first call and first text; NULL only if both are NULL."""
    return F.least(F.col("first_sales_call_date"), F.col("first_text_sent_date"))


def entity_leads(stg: DataFrame, p: Params) -> DataFrame:
    """Leads with channel, touches, speed to lead and the converted flag."""
    form = F.col("form_submission_date")
    contact = first_contact()
    speed_ok = (form.isNotNull() & (form >= fn.ts_literal(p.speed_guard))
                & contact.isNotNull() & (contact >= form))
    return stg.select(
        "lead_id", *LEAD_TIMESTAMPS,
        "sales_call_count", "sales_text_count", "sales_email_count",
        (F.col("sales_call_count") + F.col("sales_text_count") + F.col("sales_email_count"))
        .alias("total_touch_count"),
        "predicted_sales_with_owner",
        *present(stg, *LIST_COLUMNS),
        "location_count", "connected_with_decision_maker", "status", "converted_opportunity_id", *present(stg, ROWS, RAW),
        F.when(form.isNotNull(), F.lit(L.INBOUND)).otherwise(F.lit(L.OUTBOUND)).alias("channel"),
        F.when(speed_ok, fn.minute_diff(form, contact)).alias("speed_to_lead_minutes"),
        F.col("converted_opportunity_id").isNotNull().alias("is_converted"),
    )


def entity_opportunities(stg: DataFrame) -> DataFrame:
    """Opportunities with outcome, cycle times and closed flags."""
    stage = F.col("stage_name")
    created, close, demo = F.col("created_date"), F.col("close_date"), F.col("demo_set_date")
    return stg.select(
        "opportunity_id", "stage_name",
        F.when(stage == L.STAGE_CLOSED_WON, F.lit(L.WON)).when(stage == L.STAGE_CLOSED_LOST, F.lit(L.LOST))
        .otherwise(F.lit(L.OPEN)).alias("deal_outcome"),
        "lost_reason_c", "closed_lost_notes_c", "business_issue_c", "how_did_you_hear_about_us_c",
        "created_date", "demo_held", "demo_set_date", "demo_time", "close_date", "last_sales_call_date_time",
        F.when(close.isNotNull() & created.isNotNull(), fn.day_diff(created, close)).alias("days_to_close"),
        F.when(demo.isNotNull() & created.isNotNull(), fn.day_diff(created, demo)).alias("days_to_demo"),
        F.when(close.isNotNull() & demo.isNotNull(), fn.day_diff(demo, close)).alias("days_demo_to_close"),
        # plain comparisons: NULL stage gives NULL flags (deal_outcome is 'Open')
        (stage == L.STAGE_CLOSED_WON).alias("is_closed_won"),
        (stage == L.STAGE_CLOSED_LOST).alias("is_closed_lost"),
        stage.isin(L.STAGE_CLOSED_WON, L.STAGE_CLOSED_LOST).alias("is_closed"),
        "account_id", *present(stg, ROWS, RAW),
    )


__all__ = [
    "ingress", "raw_leads", "raw_opportunities", "raw_expenses", "stg_leads", "stg_opportunities",
    "stg_expenses_advertising", "stg_expenses_salary", "entity_leads", "entity_opportunities",
    "first_contact", "shared_rows", "ledger_rows",
]
