"""Compare two snapshots of a table keyed by ``keys``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_snapshots(prev: DataFrame, curr: DataFrame, keys: Sequence[str], watched: Sequence[str],
                   carry: Sequence[str] = ()) -> DataFrame:
    """Rows that entered, left, or changed a watched column between snapshots.

    A full outer join on the keys (unique per snapshot, so no key fans out):
    both sides are hash-partitioned on the keys and each task compares its
    own key range.  Watched columns are compared NULL-safely.  ``carry``
    columns are taken from the current row, else the previous one.
    """
    keys, watched, carry = list(keys), list(watched), list(carry)
    p = prev.select(*keys, *[F.col(c).alias(f"prev_{c}") for c in watched + carry], F.lit(True).alias("_in_prev"))
    c = curr.select(*keys, *[F.col(x).alias(f"curr_{x}") for x in watched + carry], F.lit(True).alias("_in_curr"))
    j = p.join(c, keys, "full_outer")
    changed = None
    for w in watched:
        d = ~F.col(f"prev_{w}").eqNullSafe(F.col(f"curr_{w}"))
        changed = d if changed is None else changed | d
    kind = (F.when(F.col("_in_prev").isNull(), F.lit("entered"))
            .when(F.col("_in_curr").isNull(), F.lit("left"))
            .when(changed, F.lit("changed")))
    out = j.select(
        *keys,
        *[F.coalesce(F.col(f"curr_{x}"), F.col(f"prev_{x}")).alias(x) for x in carry],
        *[F.col(f"prev_{w}") for w in watched], *[F.col(f"curr_{w}") for w in watched],
        kind.alias("change_type"),
    )
    return out.filter(F.col("change_type").isNotNull())
