"""Data-quality checks: each returns the violating rows (0 rows = pass)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (``left_anti``)."""
    probe = child.filter(F.col(fk).isNotNull())
    parents = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    out = probe.join(parents, probe[fk] == parents["_pk"], "left_anti")
    return out.select(*(list(keep) or child.columns))


def violations(df: DataFrame, predicate: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Rows that match ``predicate`` (a predicate that is NULL does not match)."""
    return df.filter(predicate).select(*(list(keep) or df.columns))


def failure_count(df: DataFrame, check: str) -> DataFrame:
    """One row: the check name and how many rows violate it."""
    return df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(check).alias("check_name"), "failures")
