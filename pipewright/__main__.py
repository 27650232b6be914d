"""Command line: build the tables, run the checks, run a query or SQL.

    python -m pipewright run   --data /root/testdata/sf0.1 [--out PATH]
    python -m pipewright test  --data /root/testdata/sf0.1
    python -m pipewright query --data /root/testdata/sf0.1 rpt_funnel_summary
    python -m pipewright sql   --data /root/testdata/sf0.1 "SELECT * FROM rpt_pipeline_health"
    python -m pipewright explain --data /root/testdata/sf0.1 rpt_funnel_summary

``--data`` is a folder of driver tables (projected by the source adapter);
``--sources`` instead names a folder holding the four source tables as
Parquet (leads/, opportunities/, expenses_advertising/,
expenses_salary_and_commissions/).  The session is the one ``spark-submit``
provides, or a local one.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from pyspark.sql import SparkSession

from .params import DEFAULT
from .plans import Pipeline
from .plans.checks import check_summary
from .session import LOCAL_SQL_CONF
from .sources import Sources


def _session() -> SparkSession:
    """The active session, else one from the builder.

    Under ``spark-submit`` the builder picks up the submitted master and
    settings; run as a plain Python module it starts locally.  Only SQL
    settings the run relies on are added (UTC, AQE); the web UI stays off.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    spark = SparkSession.builder.appName("pipewright").config("spark.ui.enabled", "false").getOrCreate()
    for k, v in LOCAL_SQL_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _pipeline(spark: SparkSession, args) -> Pipeline:
    params = DEFAULT if not args.as_of else dataclasses.replace(DEFAULT, as_of=args.as_of)
    if args.sources:
        base = args.sources.rstrip("/")
        keys = ("leads", "opportunities", "expenses_advertising", "expenses_salary_and_commissions")
        return Pipeline(spark, Sources.from_parquet(spark, {k: f"{base}/{k}" for k in keys}), params)
    return Pipeline.from_driver(spark, args.data, params)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="pipewright")
    ap.add_argument("command", choices=("run", "test", "query", "sql", "explain"))
    ap.add_argument("target", nargs="?", help="query key (query) or SQL text (sql)")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--data", help="folder of driver tables")
    src.add_argument("--sources", help="folder of the four source tables (Parquet)")
    ap.add_argument("--out", help="where run writes the tables (default: the checkpoint folder)")
    ap.add_argument("--rows", type=int, default=50, help="rows to show")
    ap.add_argument("--as-of", help="dataset end date for ages and waits (default: the fixed one)")
    args = ap.parse_intermixed_args(argv)

    spark = _session()
    pl = _pipeline(spark, args)
    if args.command == "run":
        for name, path in pl.materialize(args.out).items():
            print(f"{name}\t{path}")
        return 0
    if args.command == "test":
        rows = check_summary(pl).collect()
        failed = [r for r in rows if r.failures != 0]  # an unknown number is a failure too
        for r in rows:
            print(f"{'pass' if r.failures == 0 else 'FAIL'}\t{r.failures}\t{r.check_name}")
        return 1 if failed else 0
    if args.command in ("query", "explain"):
        from .plans.registry import QUERIES, using

        if args.target not in QUERIES:
            print(f"unknown query {args.target!r}; known: {', '.join(sorted(QUERIES))}", file=sys.stderr)
            return 2
        if args.sources and args.target.startswith("gen_"):
            print(f"{args.target} reads the driver tables: give --data", file=sys.stderr)
            return 2
        with using(pl):
            df = QUERIES[args.target](spark, args.data or "")
        if args.command == "explain":
            df.explain("formatted")
        else:
            df.show(args.rows, truncate=False)
        return 0
    pl.register_views()
    spark.sql(args.target).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
