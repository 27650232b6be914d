"""Rolling and lagged measures over an ordered partition.

The frame counts rows, not calendar units: a missing month makes the window
reach further back, exactly like ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numeric import money, round_half, safe_div


def ordered(partition: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(*[F.col(o).asc_nulls_first() for o in order])


def trailing(partition: Sequence[str], order: Sequence[str], rows: int) -> WindowSpec:
    return ordered(partition, order).rowsBetween(-(rows - 1), Window.currentRow)


def rolling_mean(value: str, w: WindowSpec, digits: int) -> Column:
    """AVG over the frame (NULLs skipped), from the exact sum."""
    return round_half(safe_div(F.sum(money(value)).over(w), F.count(F.col(value)).over(w)), digits)


def rolling_count(w: WindowSpec) -> Column:
    """COUNT(*) over the frame (rows, NULL values included)."""
    return F.count(F.lit(1)).over(w).cast("bigint")
