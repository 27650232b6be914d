"""Data-quality checks on every layer (0 violating rows = pass)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import count_if
from ..operators import check_orphans, violations
from . import layers, reports
from .pipeline import Pipeline

# (model, key column, also tested not_null)
KEY_TESTS = [
    ("ingress_leads", "lead_id", False),
    ("ingress_opportunities", "opportunity_id", False),
    ("ingress_expenses_advertising", "month", True),
    ("ingress_expenses_salary", "month", True),
    ("raw_leads", "lead_id", True),
    ("raw_opportunities", "opportunity_id", True),
    ("raw_expenses_advertising", "month", True),
    ("raw_expenses_salary", "month", True),
    ("stg_leads", "lead_id", True),
    ("stg_opportunities", "opportunity_id", True),
    ("stg_expenses_advertising", "expense_month", True),
    ("stg_expenses_salary", "expense_month", True),
    ("entity_leads", "lead_id", True),
    ("entity_opportunities", "opportunity_id", True),
    ("ops_leads", "lead_id", True),
    ("ops_opportunities", "opportunity_id", True),
    ("ops_expenses", "expense_month", True),
    ("rpt_funnel_summary", "channel", True),
    ("rpt_monthly_unit_economics", "expense_month", True),
    ("rpt_cac_ltv_by_channel", "channel", True),
    ("rpt_lead_outreach_priority", "lead_id", True),
]

def without_close_date() -> Column:
    return (F.col("is_closed") == F.lit(True)) & F.col("close_date").isNull()


def both_flags() -> Column:
    return (F.col("is_closed_won") == F.lit(True)) & (F.col("is_closed_lost") == F.lit(True))


def negative_cost() -> Column:
    return ((F.col("cac").isNotNull() & (F.col("cac") < 0))
            | (F.col("total_cost_6mo").isNotNull() & (F.col("total_cost_6mo") < 0)))


def closed_without_close_date(pl: Pipeline) -> DataFrame:
    return violations(pl.entity_opportunities, without_close_date(), ["opportunity_id", "stage_name", "close_date"])


def closed_flags_both_true(pl: Pipeline) -> DataFrame:
    return violations(pl.entity_opportunities, both_flags(), ["opportunity_id", "is_closed_won", "is_closed_lost"])


def negative_cac_or_cost(pl: Pipeline) -> DataFrame:
    return violations(pl.rpt_cac_ltv_by_channel, negative_cost(), ["channel", "cac", "total_cost_6mo"])


def lead_orphans(pl: Pipeline) -> DataFrame:
    """Leads whose converted_opportunity_id has no opportunity.

    ``left_anti`` after dropping NULL keys, so the unconverted majority never
    enters the shuffle.
    """
    return check_orphans(pl.entity_leads, "converted_opportunity_id", pl.entity_opportunities,
                         "opportunity_id", ["lead_id", "converted_opportunity_id"])


def _key_counts(df: DataFrame, key: str, rules: list[tuple[str, Column, bool]], others: dict[str, Column] | None = None) -> DataFrame:
    """``unique`` and ``not_null`` of one key in every model of ``rules``, and the row rules ``others``, in one aggregation.

    ``rules``: (model, the number of its rows in a group of one key, also not_null);
    ``others``: (check, aggregate over the rows).  Rows are counted per key value
    (partial counts combined map-side); the duplicated values and the size of the
    NULL group are then read off that one result.
    """
    others = others or {}
    per_key = df.groupBy(key).agg(*[n.alias(f"_n{i}") for i, (_, n, _) in enumerate(rules)],
                                  *[e.alias(f"_o{i}") for i, e in enumerate(others.values())])
    k = F.col(key)
    found: dict[str, Column] = {}
    for i, (model, _, not_null) in enumerate(rules):
        n = F.col(f"_n{i}")
        found[f"unique:{model}.{key}"] = count_if(k.isNotNull() & (n > 1))
        if not_null:
            found[f"not_null:{model}.{key}"] = F.coalesce(F.sum(F.when(k.isNull(), n)), F.lit(0)).cast("bigint")
    found |= {name: F.coalesce(F.sum(f"_o{i}"), F.lit(0)).cast("bigint") for i, name in enumerate(others)}
    totals = per_key.agg(*[e.alias(f"_c{i}") for i, e in enumerate(found.values())])
    rows = [x for i, name in enumerate(found) for x in (F.lit(name), F.col(f"_c{i}"))]
    return totals.select(F.stack(F.lit(len(found)), *rows).alias("check_name", "failures"))


def _each_row() -> Column:
    return F.count(F.lit(1))


def check_summary(pl: Pipeline) -> DataFrame:
    """One row per check: its name and the number of failing rows.

    All rules of a source, on every layer from ingress to entity, are one
    aggregation over its shared rows, which are grouped by the source's key
    already; the rules on tables and reports that are not stored read the same
    rows.  So each source is scanned once and shuffled by its key once.
    """
    s, tests = pl.shared, {model: (key, not_null) for model, key, not_null in KEY_TESTS}
    source_rows = F.sum(layers.ROWS)

    def layer_rules(entity: str, *more: tuple[str, Column]) -> list[tuple[str, Column, bool]]:
        names = [f"{layer}_{entity}" for layer in ("raw", "stg", "entity") if f"{layer}_{entity}" in tests]
        counted = [(f"ingress_{entity}", source_rows), *[(n, _each_row()) for n in names], *more]
        return [(name, n, tests[name][1]) for name, n in counted]

    here = [(name, n) for name, n in (("ops_leads", _each_row()), ("rpt_lead_outreach_priority", count_if(reports.in_outreach_queue())))
            if not pl.is_stored(name)]
    parts = [
        _key_counts(s.ops_leads, "lead_id", layer_rules("leads", *here)),
        _key_counts(s.entity_opportunities, "opportunity_id", layer_rules("opportunities"),
                    {"closed_deals_have_close_date": count_if(without_close_date()), "closed_flags_mutually_exclusive": count_if(both_flags())}),
        orphan_count(pl),
    ]
    for ledger in ("expenses_advertising", "expenses_salary"):
        raw, staged = getattr(s, f"raw_{ledger}"), getattr(s, f"stg_{ledger}")
        parts.append(_key_counts(raw, "month", [(f"ingress_{ledger}", source_rows, True), (f"raw_{ledger}", _each_row(), True)]))
        parts.append(_key_counts(staged, "expense_month", [(f"stg_{ledger}", _each_row(), True)]))
    deals, leads = pl.deals_and_leads()
    costs = pl.table("ops_expenses") if pl.is_stored("ops_expenses") else s.ops_expenses
    unstored = {
        "ops_opportunities": lambda: deals,
        "ops_expenses": lambda: costs,
        "rpt_funnel_summary": lambda: reports.rpt_funnel_summary(leads, deals),
        "rpt_monthly_unit_economics": lambda: reports.rpt_monthly_unit_economics(costs, leads, deals),
        "rpt_cac_ltv_by_channel": lambda: reports.rpt_cac_ltv_by_channel(deals, costs, pl.p),
    }
    for model, (key, not_null) in tests.items():
        if model in unstored or pl.is_stored(model):
            df = pl.table(model) if pl.is_stored(model) else unstored[model]()
            others = {"no_negative_cac_or_cost": count_if(negative_cost())} if model == "rpt_cac_ltv_by_channel" else None
            parts.append(_key_counts(df, key, [(model, _each_row(), not_null)], others))
    return reduce(DataFrame.unionByName, parts).select(
        "check_name", F.col("failures").cast("bigint").alias("failures"))


def orphan_count(pl: Pipeline) -> DataFrame:
    """How many leads :func:`lead_orphans` finds, from the leads already grouped by their opportunity."""
    named = pl.shared.lead_per_opportunity.select("converted_opportunity_id", F.col(layers.ROWS).alias("leads"))
    known = pl.shared.entity_opportunities.select("opportunity_id")
    # an anti join would filter the opportunities' NULL keys below their exchange and so not share it
    both = named.join(known, named["converted_opportunity_id"] == known["opportunity_id"], "full_outer")
    lost = F.sum(F.when(F.col("opportunity_id").isNull(), F.col("leads")))
    return both.agg(F.coalesce(lost, F.lit(0)).alias("failures")) \
        .select(F.lit("referential_integrity_leads_to_opportunities").alias("check_name"), "failures")


def parse_failures(pl: Pipeline) -> DataFrame:
    """Side counts of dirty values the cleaning rules turned into NULL or 0.

    Not failing tests (the rules are tolerant by design) but the numbers a
    data-quality report needs: present text that did not parse.  One pass
    over each raw table.
    """
    def lost(raw: str, parsed) -> F.Column:
        return count_if(F.col(raw).isNotNull() & parsed.isNull())

    def unparsed_list(raw: str) -> F.Column:
        text = F.trim(F.col(raw))
        return count_if(text.isNotNull() & ~text.isin("[]", "") & (fn.list_count(raw) == 0))

    leads = pl.raw_leads.agg(
        lost("predicted_sales_with_owner", fn.decimal_comma("predicted_sales_with_owner")).alias("a"),
        unparsed_list("marketplaces_used").alias("b"),
        unparsed_list("online_ordering_used").alias("c"),
        unparsed_list("cuisine_types").alias("d"),
    ).select(F.stack(F.lit(4),
                     F.lit("parse:stg_leads.predicted_sales_with_owner"), "a",
                     F.lit("parse:stg_leads.marketplace_count"), "b",
                     F.lit("parse:stg_leads.online_ordering_count"), "c",
                     F.lit("parse:stg_leads.cuisine_type_count"), "d").alias("check_name", "failures"))
    ad = pl.raw_expenses_advertising.agg(
        lost("advertising", fn.parse_currency("advertising")).alias("a")
    ).select(F.lit("parse:stg_expenses_advertising.advertising_spend").alias("check_name"), F.col("a").alias("failures"))
    sal = pl.raw_expenses_salary.agg(
        lost("outbound_sales_team", fn.parse_currency("outbound_sales_team")).alias("a"),
        lost("inbound_sales_team", fn.parse_currency("inbound_sales_team")).alias("b"),
    ).select(F.stack(F.lit(2),
                     F.lit("parse:stg_expenses_salary.outbound_sales_team_cost"), "a",
                     F.lit("parse:stg_expenses_salary.inbound_sales_team_cost"), "b").alias("check_name", "failures"))
    # two-digit years read as 20yy: a month after the as-of date means the
    # text meant another century (or is simply wrong)
    as_of = fn.date_literal(pl.p.as_of)
    future = [
        pl.table(t).agg(F.coalesce(count_if(F.col("expense_month") > as_of), F.lit(0)).alias("failures"))
        .select(F.lit(f"range:{t}.expense_month").alias("check_name"), "failures")
        for t in ("stg_expenses_advertising", "stg_expenses_salary")
    ]
    return reduce(DataFrame.unionByName, [leads, ad, sal, *future]).select(
        "check_name", F.col("failures").cast("bigint").alias("failures"))
