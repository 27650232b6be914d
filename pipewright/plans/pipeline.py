"""The model graph as one object: one method per model, each a DataFrame.

View layers stay lazy.  ``materialize()`` writes the operational and
reporting tables as Parquet under the cluster's shared checkpoint folder (or
a given path), each build in folders of its own (``plans/store.py``), and rebinds
the pipeline to read them back, which cuts the lineage the way the warehouse's
stored tables do: a lost executor recomputes from the written table, not from the
sources.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from ..session import checkpoint_dir
from ..sources import Sources, schemas
from . import layers, ops, reports, store
from .shared import SharedFrames

VIEW_MODELS = (
    "ingress_leads", "ingress_opportunities", "ingress_expenses_advertising", "ingress_expenses_salary",
    "raw_leads", "raw_opportunities", "raw_expenses_advertising", "raw_expenses_salary",
    "stg_leads", "stg_opportunities", "stg_expenses_advertising", "stg_expenses_salary",
    "entity_leads", "entity_opportunities",
)
OPS_TABLES = ("ops_leads", "ops_opportunities", "ops_expenses", "ops_pipeline_health")
# which stored tables each table reads (the waves of a build)
DEPENDS_ON = {
    "ops_opportunities": ("ops_leads",),
    "ops_pipeline_health": ("ops_opportunities", "ops_leads"),
    "rpt_cac_ltv_by_channel": ("ops_opportunities", "ops_expenses"),
    "rpt_funnel_summary": ("ops_leads", "ops_opportunities"),
    "rpt_monthly_unit_economics": ("ops_expenses", "ops_leads", "ops_opportunities"),
    "rpt_channel_efficiency": ("rpt_monthly_unit_economics",),
    "rpt_pipeline_health": ("ops_pipeline_health",),
    "rpt_lead_outreach_priority": ("ops_leads",),
}
REPORT_TABLES = (
    "rpt_cac_ltv_by_channel", "rpt_funnel_summary", "rpt_monthly_unit_economics", "rpt_channel_efficiency",
    "rpt_pipeline_health", "rpt_lead_outreach_priority",
)


class Pipeline:
    def __init__(self, spark: SparkSession, sources: Sources, params: Params = DEFAULT, as_it_was: bool = False):
        """``as_it_was``: the open pipeline holds only what existed on the as-of date, deals closed since still open."""
        self.spark = spark
        self.sources = sources
        self.p = params
        self.as_it_was = as_it_was
        self._tables: dict[str, DataFrame] = {}   # materialized (read back from Parquet)
        self._built: dict[str, DataFrame] = {}    # lazy plans built so far

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> "Pipeline":
        return cls(spark, Sources.from_driver(spark, sf_dir), params)

    def _stored(self, name: str, build) -> DataFrame:
        if name in self._tables:
            return self._tables[name]
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    # ---------------------------------------------------------- ingress
    @cached_property
    def ingress_leads(self) -> DataFrame:
        return layers.ingress(self.sources.leads, schemas.LEADS)

    @cached_property
    def ingress_opportunities(self) -> DataFrame:
        return layers.ingress(self.sources.opportunities, schemas.OPPORTUNITIES)

    @cached_property
    def ingress_expenses_advertising(self) -> DataFrame:
        return layers.ingress(self.sources.expenses_advertising, schemas.EXPENSES_ADVERTISING)

    @cached_property
    def ingress_expenses_salary(self) -> DataFrame:
        return layers.ingress(self.sources.expenses_salary, schemas.EXPENSES_SALARY)

    # -------------------------------------------------------------- raw
    @cached_property
    def raw_leads(self) -> DataFrame:
        return layers.raw_leads(layers.ingress(self.sources.leads, schemas.LEADS, keep_position=True))

    @cached_property
    def raw_opportunities(self) -> DataFrame:
        return layers.raw_opportunities(
            layers.ingress(self.sources.opportunities, schemas.OPPORTUNITIES, keep_position=True))

    @cached_property
    def raw_expenses_advertising(self) -> DataFrame:
        return layers.raw_expenses(self.ingress_expenses_advertising)

    @cached_property
    def raw_expenses_salary(self) -> DataFrame:
        return layers.raw_expenses(self.ingress_expenses_salary)

    # ---------------------------------------------------------- staging
    @cached_property
    def stg_leads(self) -> DataFrame:
        return layers.stg_leads(self.raw_leads)

    @cached_property
    def stg_opportunities(self) -> DataFrame:
        return layers.stg_opportunities(self.raw_opportunities)

    @cached_property
    def stg_expenses_advertising(self) -> DataFrame:
        return layers.stg_expenses_advertising(self.raw_expenses_advertising, self.p.tolerant_months)

    @cached_property
    def stg_expenses_salary(self) -> DataFrame:
        return layers.stg_expenses_salary(self.raw_expenses_salary, self.p.tolerant_months)

    # ----------------------------------------------------------- entity
    @cached_property
    def entity_leads(self) -> DataFrame:
        return layers.entity_leads(self.stg_leads, self.p)

    @cached_property
    def entity_opportunities(self) -> DataFrame:
        return layers.entity_opportunities(self.stg_opportunities)

    # ------------------------------------------------------ operational
    @property
    def ops_leads(self) -> DataFrame:
        return self._stored("ops_leads", lambda: ops.ops_leads(self.entity_leads, self.p))

    @property
    def ops_opportunities(self) -> DataFrame:
        return self._stored("ops_opportunities",
                            lambda: ops.ops_opportunities(self.entity_opportunities, self.ops_leads, self.p))

    @property
    def ops_expenses(self) -> DataFrame:
        return self._stored("ops_expenses",
                            lambda: ops.ops_expenses(self.stg_expenses_advertising, self.stg_expenses_salary))

    @property
    def ops_pipeline_health(self) -> DataFrame:
        return self._stored("ops_pipeline_health", lambda: self.shared.pipeline_health_on(self.p) if self.as_it_was
                            else ops.ops_pipeline_health(*self.deals_and_leads(), self.p))

    @cached_property
    def shared(self) -> SharedFrames:
        """The models' frames for queries that read a source more than once."""
        return SharedFrames(self.sources, self.p)

    def deals_and_leads(self) -> tuple[DataFrame, DataFrame]:
        """ops_opportunities and ops_leads for a reader of both: stored tables, else the shared frames."""
        if self.is_stored("ops_opportunities") or self.is_stored("ops_leads"):
            return self.ops_opportunities, self.ops_leads
        return self.shared.ops_opportunities, self.shared.ops_leads

    # -------------------------------------------------------- reporting
    @property
    def rpt_cac_ltv_by_channel(self) -> DataFrame:
        return self._stored("rpt_cac_ltv_by_channel",
                            lambda: reports.rpt_cac_ltv_by_channel(self.ops_opportunities, self.ops_expenses, self.p))

    @property
    def rpt_funnel_summary(self) -> DataFrame:
        return self._stored("rpt_funnel_summary", lambda: reports.rpt_funnel_summary(*self.deals_and_leads()[::-1]))

    @property
    def rpt_monthly_unit_economics(self) -> DataFrame:
        return self._stored("rpt_monthly_unit_economics", lambda: reports.rpt_monthly_unit_economics(
            self.ops_expenses, *self.deals_and_leads()[::-1]))

    @property
    def rpt_channel_efficiency(self) -> DataFrame:
        return self._stored("rpt_channel_efficiency",
                            lambda: reports.rpt_channel_efficiency(self.rpt_monthly_unit_economics, self.p))

    @property
    def rpt_pipeline_health(self) -> DataFrame:
        return self._stored("rpt_pipeline_health", lambda: reports.rpt_pipeline_health(self.ops_pipeline_health))

    @property
    def rpt_lead_outreach_priority(self) -> DataFrame:
        return self._stored("rpt_lead_outreach_priority",
                            lambda: reports.rpt_lead_outreach_priority(self.ops_leads, self.p))

    def is_stored(self, name: str) -> bool:
        return name in self._tables

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    # ---------------------------------------------------- views and tables
    def register_views(self, names=VIEW_MODELS + OPS_TABLES + REPORT_TABLES) -> list[str]:
        """Every model as a temporary view, for ``spark.sql`` over the models.

        Views are lazy: a query over ``rpt_pipeline_health`` plans the whole
        chain (or reads the stored table once ``materialize`` has run).
        """
        for name in names:
            self.table(name).createOrReplaceTempView(name)
        return list(names)

    # -------------------------------------------- what the view layers are read from
    def _base(self, source: str) -> DataFrame:
        """A source's kept rows with all columns of its staging and entity models, and the raw row beside them."""
        raw = self.table(f"raw_{source}")
        raw = raw.withColumn(layers.RAW, F.struct(*raw.columns))
        if source == "leads":
            return layers.entity_leads(layers.stg_leads(raw), self.p)
        if source == "opportunities":
            return layers.entity_opportunities(layers.stg_opportunities(raw))
        return getattr(layers, f"stg_{source}")(raw, self.p.tolerant_months)

    def view_columns(self) -> dict[str, tuple[str, list[str]]]:
        """For each model of the raw, staging and entity layers its base and what it takes of it."""
        found = {}
        for source in store.SOURCES:
            for model in (f"raw_{source}", f"stg_{source}", f"entity_{source}"):
                if model in VIEW_MODELS:
                    at = f"{layers.RAW}." if model.startswith("raw_") else ""
                    found[model] = (f"base_{source}", [f"{at}`{c}`" for c in self.table(model).columns])
        return found

    def _tables_path(self, path: str | None) -> str:
        """``path``, else a folder under the configured ``spark.checkpoint.dir``.

        The configured folder is the same in every session; the one Spark
        makes below it for its own checkpoints is new in each.
        """
        shared = self.spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(self.spark)
        return (path or f"{shared.rstrip('/')}/pipewright-tables").rstrip("/")

    def materialize(self, path: str | None = None, tables=OPS_TABLES + REPORT_TABLES,
                    schema_prefix: str | None = None, threads: int = 4, view_layers: bool = False) -> dict[str, str]:
        """Rebuild the tables from the sources and read the stored ones from then on.

        Tables are written in dependency order to the build's own folders
        (``plans/store.py``); a table never reads what is being rebuilt.  Only
        when all are written does the build count: one manifest file makes it the
        latest for every reader, and this pipeline reads it.  A build that fails
        leaves the tables of the one before as they were.

        ``schema_prefix`` names the tables in the catalog, as
        ``<prefix>_<layer>.<name>``, or ``<layer>.<name>`` if it is empty;
        ``view_layers`` stores the base of the ingress, raw, staging and entity
        layers as well and names their models too.

        Tables are written in waves: every table whose inputs are already
        stored is written in the same wave, as concurrent Spark jobs from
        ``threads`` driver threads (plans are built on the calling thread).
        """
        builds, run = self._store(path), store.new_run()
        tables = (*tables, *store.VIEW_BASES) if view_layers else tuple(tables)
        before = self._tables
        self._tables = {k: v for k, v in before.items() if k not in tables}
        self._built.clear()
        written: dict[str, str] = {}
        try:
            pending = list(tables)
            while pending:
                wave = [t for t in pending if not (set(DEPENDS_ON.get(t, ())) & set(pending))]
                frames = {t: self._base(t.removeprefix("base_")) if t.startswith("base_") else self.table(t) for t in wave}
                with ThreadPoolExecutor(max_workers=max(1, min(threads, len(wave)))) as pool:
                    for job in [pool.submit(df.write.parquet, builds.path(name, run)) for name, df in frames.items()]:
                        job.result()
                written |= {name: builds.path(name, run) for name in wave}
                # later tables read the stored ones, not the plans they come from
                self._tables |= {name: self.spark.read.parquet(written[name]) for name in wave if name not in store.VIEW_BASES}
                self._built.clear()
                pending = [t for t in pending if t not in wave]
            builds.commit(run, written)
        except BaseException:
            self._tables = before
            self._built.clear()
            raise
        if schema_prefix is not None:
            builds.define(written, schema_prefix, self.view_columns() if view_layers else {})
        return written

    def _store(self, path: str | None = None) -> store.Store:
        return store.Store(self.spark, self._tables_path(path))

    def runs(self, path: str | None = None) -> list[str]:
        """The complete builds under ``path``, oldest first."""
        return self._store(path).runs()

    def open_tables(self, path: str | None = None, run: str | None = None) -> dict[str, str]:
        """Read the tables from now on as the build ``run`` (default: the latest) left them."""
        found = self._store(path).paths(run)
        self._tables = {name: self.spark.read.parquet(at) for name, at in found.items() if name not in store.VIEW_BASES}
        self._built.clear()
        return found

    def present(self, name: str) -> DataFrame:
        """A report in its presentation order (sorting is not stored)."""
        df = self.table(name)
        if name == "rpt_lead_outreach_priority":
            return df.orderBy(*reports.outreach_order())
        order = reports.PRESENTATION_ORDER.get(name)
        return df.orderBy(*order) if order else df
