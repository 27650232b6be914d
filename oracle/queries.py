"""Oracle SQL per registered query key (DuckDB over the driver's views)."""

from __future__ import annotations

from .models import compose
from .sqlkit import ts_text, date_text

SRC_TS = {
    "src_leads": ["form_submission_date", "first_sales_call_date", "first_text_sent_date",
                  "first_meeting_booked_date", "last_sales_call_date", "last_sales_activity_date",
                  "last_sales_email_date"],
    "src_opportunities": ["created_date", "demo_time", "last_sales_call_date_time"],
}
SRC_DATES = {"src_opportunities": ["demo_set_date", "close_date"]}
SRC_COLUMNS = {
    "src_leads": ["lead_id", "form_submission_date", "first_sales_call_date", "first_text_sent_date",
                  "first_meeting_booked_date", "last_sales_call_date", "last_sales_activity_date",
                  "last_sales_email_date", "sales_call_count", "sales_text_count", "sales_email_count",
                  "predicted_sales_with_owner", "marketplaces_used", "online_ordering_used", "cuisine_types",
                  "location_count", "connected_with_decision_maker", "status", "converted_opportunity_id"],
    "src_opportunities": ["opportunity_id", "stage_name", "lost_reason_c", "closed_lost_notes_c", "business_issue_c",
                          "how_did_you_hear_about_us_c", "created_date", "demo_held", "demo_set_date", "demo_time",
                          "close_date", "last_sales_call_date_time", "account_id"],
}


def _src(name: str) -> str:
    cols = []
    for c in SRC_COLUMNS[name]:
        if c in SRC_TS.get(name, []):
            cols.append(f"{ts_text(c)} AS {c}")
        elif c in SRC_DATES.get(name, []):
            cols.append(f"{date_text(c)} AS {c}")
        else:
            cols.append(c)
    return compose(f"SELECT {', '.join(cols)} FROM {name}", [name])


def table(name: str) -> str:
    return compose(f"SELECT * FROM {name}", [name])


ORACLE: dict[str, str] = {
    "src_leads": _src("src_leads"),
    "src_opportunities": _src("src_opportunities"),
    "src_expenses_advertising": table("src_expenses_advertising"),
    "src_expenses_salary": table("src_expenses_salary"),
}
for _name in ("stg_leads", "stg_opportunities", "stg_expenses_advertising", "stg_expenses_salary",
              "entity_leads", "entity_opportunities", "ops_leads", "ops_opportunities", "ops_expenses",
              "ops_pipeline_health", "rpt_cac_ltv_by_channel", "rpt_funnel_summary", "rpt_monthly_unit_economics",
              "rpt_channel_efficiency", "rpt_pipeline_health", "rpt_lead_outreach_priority"):
    ORACLE[_name] = table(_name)

ORACLE["stored_pipeline_health"] = table("rpt_pipeline_health")
ORACLE["catalog_entity_leads"] = table("entity_leads")

from .analyses import Q as _ANALYSES  # noqa: E402

ORACLE.update(_ANALYSES)
