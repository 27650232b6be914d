"""Exact medians of large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
#: marks that cut what lies around a group's middle into runs
MARKS = 500


def exact_median(df: DataFrame, keys: Sequence[str], value: str, count_alias: str = "n", alias: str = "median",
                 accuracy: int = ACCURACY, marks: int = MARKS) -> DataFrame:
    """COUNT(*) and the exact median of ``value`` (NULLs skipped) per group.

    The first pass takes a bounded sketch of each group, whose rank error is at
    most 1 / ``accuracy`` of the group, and from it values that are surely below
    and above the middle.  The second counts what is below, and each distinct
    value of the band between, at most some 4 / ``accuracy`` of the rows.  The
    band grows with the group, so it is never gathered: marks taken from its own
    sketch cut it into ``marks`` runs, a running count over the runs (bounded, a
    row each) tells which hold the middle ranks, and only their values are
    counted through in order, by a window that streams and spills.  No array and
    no group of one task grows with more than the ``marks``-th part of the band.

    The sketches and run counts are a few rows per group and are broadcast: for
    groupings with a bounded number of groups (event types, channels).
    """
    keys = list(keys)

    def same(right: str) -> list:
        return [F.col(k).eqNullSafe(F.col(f"{right}{k}")) for k in keys]

    def named(prefix: str) -> list:
        return [F.col(k).alias(f"{prefix}{k}") for k in keys]

    margin = 2.0 / accuracy
    sketch = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_n"),
        F.percentile_approx(value, F.array(F.lit(0.5 - margin), F.lit(0.5 + margin)), accuracy).alias("_q"))
    marked = df.select(*keys, F.col(value).alias("_v")).join(F.broadcast(sketch.select(*named("_s_"), "_q")), same("_s_"))
    # everything below the lower mark falls into one group; so does what is above the upper one
    low, high = F.col("_q")[0], F.col("_q")[1]
    spot = F.when(F.col("_v") < low, F.lit(0)).when(F.col("_v") > high, F.lit(2)).otherwise(F.lit(1))
    counts = marked.where("_v IS NOT NULL").groupBy(*keys, spot.alias("_spot"), F.when(spot == 1, F.col("_v")).alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_c"))
    # runs: 0 is all that lies below the band, then its values between two marks
    band_marks = counts.where("_spot = 1").groupBy(*keys).agg(
        F.percentile_approx("_v", F.array(*[F.lit((i + 1) / marks) for i in range(marks)]), 10 * marks).alias("_m"))
    run = F.when(F.col("_spot") == 0, F.lit(0)).otherwise(F.size(F.filter("_m", lambda m: m < F.col("_v"))) + 1)
    placed = counts.where("_spot < 2").join(F.broadcast(band_marks.select(*named("_b_"), "_m")), same("_b_")) \
        .select(*keys, run.alias("_run"), "_v", "_c")
    order = Window.partitionBy(*keys).orderBy("_run")
    runs = placed.groupBy(*keys, "_run").agg(F.sum("_c").alias("_in"))
    runs = runs.withColumn("_before", F.sum("_in").over(order) - F.col("_in"))
    # the two middle ranks, from 0 (one if the number of values is odd)
    last = F.col("_n") - 1
    middle = runs.join(F.broadcast(sketch.select(*named("_s_"), F.floor(last / 2).alias("_lo"), F.ceil(last / 2).alias("_hi"))), same("_s_")) \
        .where("_run > 0 AND _before <= _hi AND _before + _in > _lo") \
        .select(*named("_r_"), F.col("_run").alias("_r_run"), "_before", "_lo", "_hi")
    seen = Window.partitionBy(*keys, "_run").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    through = placed.join(F.broadcast(middle), [*same("_r_"), F.col("_run") == F.col("_r_run")]) \
        .withColumn("_to", F.col("_before") + F.sum("_c").over(seen)).withColumn("_from", F.col("_to") - F.col("_c"))

    def at(rank: str):
        """The value of a rank."""
        return F.max(F.when((F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_to")), F.col("_v").cast("double")))

    values = through.groupBy(*keys).agg(((at("_lo") + at("_hi")) / 2).alias(alias)).select(*named("_t_"), alias)
    return sketch.join(values, same("_t_"), "left").select(*keys, F.col("_rows").alias(count_alias), alias)
