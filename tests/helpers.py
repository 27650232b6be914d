"""Small helpers shared by the tests."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import SparkSession

from pipewright.sources import Sources, schemas


def ts(s: str) -> dt.datetime:
    """'YYYY-MM-DD HH:MM[:SS]' with any year (0024 allowed)."""
    date, _, time = s.partition(" ")
    y, m, d = (int(x) for x in date.split("-"))
    parts = [int(x) for x in (time or "00:00").split(":")]
    while len(parts) < 3:
        parts.append(0)
    return dt.datetime(y, m, d, *parts)


def day(s: str) -> dt.date:
    y, m, d = (int(x) for x in s.split("-"))
    return dt.date(y, m, d)


LEAD_DEFAULTS = {f.name: None for f in schemas.LEADS.fields}
OPP_DEFAULTS = {f.name: None for f in schemas.OPPORTUNITIES.fields}


def leads_df(spark: SparkSession, rows: list[dict]):
    full = [{**LEAD_DEFAULTS, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.LEADS.fields) for r in full], schemas.LEADS)


def opps_df(spark: SparkSession, rows: list[dict]):
    full = [{**OPP_DEFAULTS, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.OPPORTUNITIES.fields) for r in full],
                                 schemas.OPPORTUNITIES)


def expenses(spark: SparkSession, ad_rows, sal_rows):
    return (spark.createDataFrame(ad_rows, schemas.EXPENSES_ADVERTISING),
            spark.createDataFrame(sal_rows, schemas.EXPENSES_SALARY))


def sources(spark, leads=(), opps=(), ad=(), sal=()):
    a, s = expenses(spark, list(ad), list(sal))
    return Sources(leads=leads_df(spark, list(leads)), opportunities=opps_df(spark, list(opps)),
                   expenses_advertising=a, expenses_salary=s)


def norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", repr(v + 0.0))
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if type(v).__name__ == "Decimal":
        return ("f", repr(float(v)))
    return ("s", str(v))


def canonical(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)
