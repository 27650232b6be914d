"""Calendar differences that count boundaries crossed.

A warehouse ``DATEDIFF('minute', a, b)`` counts minute boundaries between the
two values: 00:00:59 -> 00:01:01 is 1, not 0.  Spark's ``timestampdiff``
counts whole elapsed units instead, so minutes and hours are computed from
epoch seconds floored to the unit.  Days use ``datediff`` on the dates, which
already counts midnights.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


def epoch_seconds(c: str | Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock TIMESTAMP_NTZ.

    Built from the date and the clock fields, so the session time zone (and
    its DST jumps) cannot shift a difference.
    """
    c = col(c)
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def _unit_index(c: str | Column, unit_seconds: int) -> Column:
    s = epoch_seconds(c)
    return (s - F.pmod(s, F.lit(unit_seconds))) / F.lit(unit_seconds)


def minute_diff(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries from ``start`` to ``end`` (negative if end is earlier)."""
    return (_unit_index(end, 60) - _unit_index(start, 60)).cast("bigint")


def hour_diff(start: str | Column, end: str | Column) -> Column:
    return (_unit_index(end, 3600) - _unit_index(start, 3600)).cast("bigint")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Midnights from ``start`` to ``end``; either side may be a date or timestamp."""
    return F.datediff(col(end).cast("date"), col(start).cast("date")).cast("bigint")


def ts_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def date_literal(text: str) -> Column:
    return F.lit(text).cast("date")


def month_start(c: str | Column) -> Column:
    """First day of the month as DATE (``date_trunc`` returns a TIMESTAMP)."""
    return F.trunc(col(c).cast("date"), "month")


def week_start(c: str | Column) -> Column:
    """Monday of the ISO week as DATE (``dayofweek``: Sunday = 1)."""
    d = col(c).cast("date")
    return F.date_sub(d, F.pmod(F.dayofweek(d) + 5, F.lit(7)))
