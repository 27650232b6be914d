"""Connected components of a link table, by alternating star contraction.

Only links and labels move, as tables; every round is written to the shared
folder, so the lineage stays short.  The number of rounds grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _mark(links: DataFrame) -> tuple:
    """What tells two link tables apart."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b): each node that is not the smallest of its component, with that smallest node.

    ``links``: (a, b) longs in any order, repeats allowed.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        then = large.join(small, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(small.select("a", F.col("m").alias("b"))).distinct()
        now = stored(then, "links")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now
