"""Numeric column helpers.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Two rules keep results independent of partitioning and summation
order:

* money is summed as DECIMAL of the whole value (``exact_sum``), so nothing is
  rounded before the report rounds once, a sum over a billion rows gives the
  same value whatever order the partial aggregates arrive in, and it has 28
  digits before the point to grow in;
* rounding is half away from zero on the binary double
  (``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``); it is the same sequence of
  IEEE operations in every engine, which is what makes the SQL oracle
  comparable bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return col(c).cast("double")


def round_half(c: str | Column, digits: int = 0) -> Column:
    """Round half away from zero to ``digits`` decimals; NULL stays NULL."""
    x = dbl(c)
    scale = F.lit(float(10 ** digits))
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)).cast("double") / scale


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)`` as DOUBLE (NULL instead of a divide error)."""
    d = col(den)
    return F.when(d != 0, dbl(num) / dbl(d))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), digits)``."""
    return round_half(safe_div(dbl(num) * F.lit(100.0), den), digits)


def money(c: str | Column) -> Column:
    """A value as DECIMAL, with the digits its DOUBLE prints as (ten after the point)."""
    return dbl(c).cast("decimal(38,10)")


def exact_sum(c: str | Column) -> Column:
    """SUM of a column of decimal values, without an intermediate rounding."""
    return F.sum(money(c)).cast("double")


def exact_mean(c: str | Column) -> Column:
    """AVG of a column of decimal values (NULLs skipped), from its exact sum."""
    return safe_div(exact_sum(c), F.count(col(c)))


def exact_mean_of(total: str | Column, count: str | Column) -> Column:
    """AVG from partial sums (DECIMAL or integer) and counts."""
    return safe_div(F.sum(col(total)), F.sum(col(count)))


def mean(c: str | Column) -> Column:
    """AVG of an integer column as SUM / COUNT (NULLs skipped)."""
    return safe_div(F.sum(col(c)), F.count(col(c)))


def count_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` — NULL counts as false, no rows as 0."""
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")
