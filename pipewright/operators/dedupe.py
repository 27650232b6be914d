"""Keep one row per key.

``dedupe`` is ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``.
Written this way Catalyst inserts a partial ``WindowGroupLimit`` *before* the
shuffle, so each map task forwards at most one row per key: a key that holds
a third of all rows is cut down map-side and never lands whole in one task.
Ties must not depend on partitioning or task timing.  The model layers pass
the source row position (file and row index) as the last ordering columns,
which needs no data column; the generic default appends a content hash of
every remaining column (``xxhash64``), so only the columns the consumer
needs (plus 8 bytes) cross the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW_NUM = "_row_num"


def _as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def dedupe(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column] | str | Column | None = None,
           drop_null_keys: bool = False, tie_break: str | None = "hash") -> DataFrame:
    """First row per ``keys`` by ``order`` (default: the keys themselves).

    ``order`` items are column names (ascending, NULLs first) or sort
    Columns such as ``F.col('created_date').desc_nulls_first()``.
    ``drop_null_keys`` removes rows whose key is NULL before the shuffle —
    otherwise every NULL-key row meets in a single partition.
    ``tie_break``: ``"hash"`` (content hash of the other columns),
    ``"columns"`` (every other column, ascending) or ``None`` when ``order``
    is already unique within a key.
    """
    keys = _as_list(keys)
    order = _as_list(order) or list(keys)
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.filter(cond)
    order_cols = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)} | set(keys)
    rest = [c for c in df.columns if c not in named]
    if tie_break == "hash" and rest:
        ties = [F.xxhash64(*[F.col(c) for c in rest]).asc()]
    elif tie_break == "columns":
        ties = [F.col(c).asc_nulls_first() for c in rest]
    else:
        ties = []
    w = Window.partitionBy(*keys).orderBy(*order_cols, *ties)
    return df.withColumn(_ROW_NUM, F.row_number().over(w)).filter(F.col(_ROW_NUM) == 1).drop(_ROW_NUM)


def first_rows(df: DataFrame, key: str, order: Sequence[Column], columns: Sequence[str], rows: str = "_rows",
               last: bool = False) -> DataFrame:
    """The first row per ``key`` as an aggregate: (key, number of its rows, ``columns``).

    The same row as :func:`dedupe` gives, in a form that several readers of one
    query share.  Spark reuses an exchange only where the plans below it are equal,
    and column pruning makes them differ from reader to reader.  Here the row
    travels as one struct, which is not pruned, and every reader keeps it and the
    count (they are tested in a way that the optimizer cannot decide), so all
    readers have one exchange.  Partial aggregation forwards one row per key and
    map task.

    ``order``: columns whose struct is compared, smallest first (``last``: largest).
    For readers that need most of ``columns``; a single reader prunes better with
    :func:`dedupe`.
    """
    pick = F.max_by if last else F.min_by
    found = df.groupBy(key).agg(F.count(F.lit(1)).alias(rows), pick(F.struct(*columns), F.struct(*order)).alias("_row"))
    return found.where((F.col(rows) > 0) & F.col("_row").isNotNull()).select(key, rows, *[F.col(f"_row.{c}").alias(c) for c in columns])
