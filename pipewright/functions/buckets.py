"""Label a numeric column by ordered thresholds (chained CASE WHEN)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


def upper_bucket(c: str | Column, cuts: Sequence[float], labels: Sequence[str],
                 null_label: str | None = None, inclusive: bool = True) -> Column:
    """First label whose cut the value is at or under (``<=``, or ``<``).

    ``labels`` has one more entry than ``cuts``: the last one is the
    catch-all.  NULL goes to ``null_label``.
    """
    assert len(labels) == len(cuts) + 1
    x = col(c)
    expr = F.when(x.isNull(), F.lit(null_label))
    for cut, label in zip(cuts, labels):
        cond = (x <= F.lit(cut)) if inclusive else (x < F.lit(cut))
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def lower_bucket(c: str | Column, cuts: Sequence[float], labels: Sequence[str],
                 null_label: str | None = None, inclusive: bool = True) -> Column:
    """First label whose cut the value is at or over (``>=``, or ``>``)."""
    assert len(labels) == len(cuts) + 1
    x = col(c)
    expr = F.when(x.isNull(), F.lit(null_label))
    for cut, label in zip(cuts, labels):
        cond = (x >= F.lit(cut)) if inclusive else (x > F.lit(cut))
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def lookup(c: str | Column, pairs: Sequence[tuple[str, str]], default: str | None) -> Column:
    """Map values through a short literal table, ``default`` otherwise."""
    x = col(c)
    expr = None
    for key, label in pairs:
        expr = F.when(x == F.lit(key), F.lit(label)) if expr is None else expr.when(x == F.lit(key), F.lit(label))
    return expr.otherwise(F.lit(default))
