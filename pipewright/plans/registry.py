"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the source adapter) and runs
over the whole tables; none is capped or sampled, except the top-k report
whose limit is its feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir
from ..sources import as_text_timestamps
from .pipeline import OPS_TABLES, REPORT_TABLES, Pipeline

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


_USING: list[Pipeline] = []


@contextmanager
def using(pl: Pipeline) -> Iterator[None]:
    """Run the funnel queries over ``pl`` (other sources, another date) instead of the driver tables."""
    _USING.append(pl)
    try:
        yield
    finally:
        _USING.pop()


_PIPELINES: dict[tuple[int, str], tuple[SparkSession, Pipeline]] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline over ``sf_dir``, shared by the queries of one session.

    DataFrames are immutable lazy plans, so queries can share the source and
    layer plans instead of rebuilding them (building a plan costs thousands
    of driver round trips).  Nothing is cached in memory or on disk.
    """
    if _USING:
        return _USING[-1]
    key = (id(spark), sf_dir.rstrip("/"))
    hit = _PIPELINES.get(key)
    if hit is not None and hit[0] is spark:
        return hit[1]
    if len(_PIPELINES) > 8:
        _PIPELINES.clear()
    pl = Pipeline.from_driver(spark, sf_dir)
    _PIPELINES[key] = (spark, pl)
    return pl


def _model(name: str) -> QueryFn:
    return lambda spark, sf: pipeline(spark, sf).table(name)


# --------------------------------------------------------------- sources
QUERIES["src_leads"] = lambda spark, sf: as_text_timestamps(pipeline(spark, sf).ingress_leads)
QUERIES["src_opportunities"] = lambda spark, sf: as_text_timestamps(pipeline(spark, sf).ingress_opportunities)
QUERIES["src_expenses_advertising"] = lambda spark, sf: pipeline(spark, sf).ingress_expenses_advertising
QUERIES["src_expenses_salary"] = lambda spark, sf: pipeline(spark, sf).ingress_expenses_salary

# ------------------------------------------------- staging and entity layers
for _name in ("stg_leads", "stg_opportunities", "stg_expenses_advertising", "stg_expenses_salary",
              "entity_leads", "entity_opportunities"):
    QUERIES[_name] = _model(_name)

# ------------------------------------------------- operational and reports
for _name in OPS_TABLES + REPORT_TABLES:
    QUERIES[_name] = _model(_name)



@register("stored_pipeline_health")
def stored_pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline-health report read from tables that a build has stored."""
    pl = Pipeline(spark, pipeline(spark, sf_dir).sources)
    tables = ("ops_leads", "ops_opportunities", "ops_pipeline_health", "rpt_pipeline_health")
    pl.materialize(f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}", tables)
    return pl.rpt_pipeline_health


@register("catalog_entity_leads")
def catalog_entity_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity layer's leads read by their catalog name, over the base that a build has stored."""
    pl = Pipeline(spark, pipeline(spark, sf_dir).sources)
    prefix = f"pipewright_{uuid.uuid4().hex}"
    pl.materialize(f"{checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}", (), prefix, view_layers=True)
    return spark.table(f"{prefix}_entity.entity_leads")


from . import analyses  # noqa: E402,F401  (registers the analysis queries)
