"""Stored builds: their files, their manifest, and the catalog names that read them.

A build writes each table to ``<base>/<layer>/<name>/run=<run>`` and, when all are
written, one manifest file to ``<base>/builds/run=<run>``.  That file is the switch:
every reader takes of each table the latest run the manifest has, so a build that
fails before it is never seen, and all tables change with it at once.

The catalog holds views, one database a layer, whose text names the table's folder
and asks the manifest for the run.  They are defined once and stay as they are from
build to build; nothing is dropped, so no name is ever missing and no two names read
different builds.  The view layers (raw, staging, entity) have no files of their own:
they are projections of one stored base a source.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("ingress", "raw", "staging", "entity", "operational", "reporting")
SOURCES = ("leads", "opportunities", "expenses_advertising", "expenses_salary")
#: what the view layers read: the rows of each source, and the base of its raw, staging and entity models
VIEW_BASES = tuple(f"ingress_{s}" for s in SOURCES) + tuple(f"base_{s}" for s in SOURCES)


def new_run() -> str:
    """A run id; later runs have larger ones."""
    return f"r{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def layer_of(name: str) -> str:
    """The layer a model belongs to (``base`` for what the view layers read)."""
    kind = name.split("_")[0]
    return {"rpt": "reporting", "ops": "operational", "stg": "staging"}.get(kind, kind)


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, name: str, run: str) -> str:
        return f"{self.base}/{layer_of(name)}/{name}/run={run}"

    def commit(self, run: str, written: dict[str, str]) -> None:
        """One file names all tables of the run; from then on it is the latest build."""
        self.spark.createDataFrame(list(written.items()), "name string, path string").coalesce(1) \
            .write.parquet(f"{self.base}/builds/run={run}")

    def manifest(self) -> DataFrame:
        """(name, path, run) of every table of every complete build."""
        return self.spark.read.parquet(f"{self.base}/builds").withColumn("run", F.col("run").cast("string"))

    def runs(self) -> list[str]:
        """The complete builds, oldest first."""
        return [r.run for r in self.manifest().select("run").distinct().orderBy("run").collect()]

    def paths(self, run: str | None = None) -> dict[str, str]:
        """Where each table is, as the build ``run`` (default: the latest) left it."""
        rows = self.manifest()
        rows = rows.where(F.col("run") <= run) if run else rows
        return {r.name: r.path for r in rows.groupBy("name").agg(F.max_by("path", "run").alias("path")).collect()}

    def read(self, name: str, run: str | None = None) -> DataFrame:
        """One stored table, as the build ``run`` (default: the latest) left it."""
        return self.spark.read.parquet(self.paths(run)[name])

    def define(self, names, prefix: str, columns: dict[str, tuple[str, list[str]]]) -> None:
        """The catalog names of ``names``, and of the view layers whose base is among them.

        ``prefix``: put before the layers' database names, verbatim if empty.
        ``columns``: for a model of a view layer its base and the expressions it takes of it.
        """
        here = {name: (name, ["*"]) for name in names if not name.startswith("base_")}
        here |= {model: (base, exprs) for model, (base, exprs) in columns.items() if base in names}
        for model, (stored, exprs) in here.items():
            database = f"{prefix}_{layer_of(model)}" if prefix else layer_of(model)
            shown = exprs if exprs != ["*"] else [f"`{c}`" for c in self.read(stored).columns]
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
            self.spark.sql(
                f"CREATE OR REPLACE VIEW `{database}`.`{model}` AS SELECT {', '.join(shown)} "
                f"FROM parquet.`{self.base}/{layer_of(stored)}/{stored}` "
                f"WHERE run = (SELECT max(CAST(run AS STRING)) FROM parquet.`{self.base}/builds` WHERE name = '{stored}')")
