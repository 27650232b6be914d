"""Frames that several readers of one query share.

A report may read the leads twice: once by themselves and once through their
opportunities.  Over the lazy layers each reader has a plan of its own, pruned to
its own columns, and Spark shuffles the leads once for each.  The frames here keep
a key's row as one struct of an aggregate (:func:`operators.first_rows`), so that
every reader has the same exchange by ``lead_id``, by ``opportunity_id`` and by
``converted_opportunity_id``, and Spark runs it once (``ReusedExchange``).

They hold the same rows as the layers, without the leads' wide list texts and what
is counted from them, which no shared reader uses; reading one is an analysis error.
``_rows`` says how many source rows stand behind a row.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import first_rows
from ..params import Params
from ..sources import Sources, schemas
from . import layers, ops


class SharedFrames:
    def __init__(self, sources: Sources, params: Params):
        self._sources, self._p = sources, params

    @cached_property
    def ops_leads(self) -> DataFrame:
        rows = layers.ingress(self._sources.leads, schemas.LEADS, keep_position=True)
        raw = layers.shared_rows(rows, "lead_id", without=layers.LEAD_LISTS)
        return ops.ops_leads(layers.entity_leads(layers.stg_leads(raw), self._p), self._p)

    @cached_property
    def entity_opportunities(self) -> DataFrame:
        rows = layers.ingress(self._sources.opportunities, schemas.OPPORTUNITIES, keep_position=True)
        raw = layers.shared_rows(rows, "opportunity_id", newest="created_date")
        return layers.entity_opportunities(layers.stg_opportunities(raw))

    @cached_property
    def lead_per_opportunity(self) -> DataFrame:
        """The lead of the lowest id per converted opportunity, and how many leads name it (``_rows``)."""
        leads = self.ops_leads.filter(F.col("converted_opportunity_id").isNotNull())
        columns = layers.present(leads, *ops.LEAD_COLUMNS)
        return first_rows(leads.select("converted_opportunity_id", *columns), "converted_opportunity_id",
                          [F.col("lead_id")], columns, layers.ROWS)

    @cached_property
    def ops_opportunities(self) -> DataFrame:
        return self.enriched(self.entity_opportunities)

    def enriched(self, opportunities: DataFrame) -> DataFrame:
        """These opportunities with their leads."""
        return ops.enriched(opportunities, self.lead_per_opportunity, self._p)

    def pipeline_health_on(self, p: Params) -> DataFrame:
        """The open pipeline as it was on ``p.as_of``: only what existed then, deals closed since still open, ages to that day."""
        on = fn.date_literal(p.as_of)
        existed = lambda c: c.isNull() | (c.cast("date") <= on)
        opps = self.entity_opportunities.filter(existed(F.col("created_date"))).withColumn(
            "is_closed", F.when(F.col("close_date") > on, F.lit(False)).otherwise(F.col("is_closed")))
        leads = SharedFrames(self._sources, p).ops_leads.filter(existed(F.coalesce("form_submission_date", "first_sales_call_date")))
        return ops.ops_pipeline_health(self.enriched(opps), leads, p)

    @cached_property
    def raw_expenses_advertising(self) -> DataFrame:
        return layers.ledger_rows(layers.ingress(self._sources.expenses_advertising, schemas.EXPENSES_ADVERTISING))

    @cached_property
    def raw_expenses_salary(self) -> DataFrame:
        return layers.ledger_rows(layers.ingress(self._sources.expenses_salary, schemas.EXPENSES_SALARY))

    @cached_property
    def stg_expenses_advertising(self) -> DataFrame:
        return layers.stg_expenses_advertising(self.raw_expenses_advertising, self._p.tolerant_months)

    @cached_property
    def stg_expenses_salary(self) -> DataFrame:
        return layers.stg_expenses_salary(self.raw_expenses_salary, self._p.tolerant_months)

    @cached_property
    def ops_expenses(self) -> DataFrame:
        return ops.ops_expenses(self.stg_expenses_advertising, self.stg_expenses_salary)
