"""Share of total: ``COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (...)``.

The grand total is a scalar subquery (``DataFrame.scalar()``): one global
partial aggregate, broadcast as a value.  No window without PARTITION BY (which
would pull every group into one task) and no cross join.  Totals within a
group use a window partitioned by that group over the already aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import money, pct, round_half, safe_div


def share_of_total(df: DataFrame, value: str, alias: str, within: Sequence[str] | None = None,
                   digits: int = 2) -> DataFrame:
    """Add ``alias`` = ROUND(value * 100 / total of value, digits)."""
    if within:
        total: Column = F.sum(value).over(Window.partitionBy(*within))
    else:
        total = df.agg(F.sum(value)).scalar()
    return df.withColumn(alias, pct(F.col(value), total, digits))


def count_share(df: DataFrame, keys: Sequence[str], count_alias: str = "cnt", pct_alias: str = "pct",
                within: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """GROUP BY keys: COUNT(*) and its share of all rows (or of ``within``)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_alias))
    return share_of_total(counted, count_alias, pct_alias, within, digits)


def weighted_average(value: str | Column, weight: str | Column, digits: int) -> Column:
    """``ROUND(SUM(weight * value) / NULLIF(SUM(weight), 0), digits)``.

    The weighted values are summed as decimals, so their order doesn't matter.
    """
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    return round_half(safe_div(F.sum(money(w.cast("double") * v)), F.sum(w)), digits)
