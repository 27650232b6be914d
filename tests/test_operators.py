"""General operators on skewed input: one key holds a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pipewright.operators import (check_orphans, count_share, dedupe, diff_snapshots, exact_median,
                                  share_of_total, unpivot_groups)


@pytest.fixture(scope="module")
def skewed(spark):
    # 30,000 rows; key 0 holds 10,000 of them (a third), the rest are 1..20,000
    n = 30_000
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 97).alias("v"),
        F.col("id").alias("ts"),
    )


def test_dedupe_hot_key_is_cut_map_side(spark, skewed):
    out = dedupe(skewed, "k", [F.col("ts").desc()])
    assert out.count() == skewed.select("k").distinct().count()
    hot = out.filter("k = 0").first()
    assert hot.ts == 29_997                          # the latest row of the hot key
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedupe_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c")] * 3, "k int, x string")
    picks = {dedupe(df.repartition(n), "k").first().x for n in (1, 2, 5)}
    assert len(picks) == 1


def test_share_of_total_over_hot_key(spark, skewed):
    shares = count_share(skewed, ["k"], "cnt", "pct", digits=4)
    hot = shares.filter("k = 0").first()
    assert hot.cnt == 10_000 and abs(hot.pct - 33.3333) < 1e-9
    total = shares.agg(F.sum("cnt")).first()[0]
    assert total == 30_000


def test_share_within_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, n long")
    got = {(r.g, r.n): r.p for r in share_of_total(df, "n", "p", within=["g"]).collect()}
    assert got == {("a", 1): 25.0, ("a", 3): 75.0, ("b", 5): 100.0}


def test_exact_median(spark):
    import random
    import statistics

    r = random.Random(3)
    rows = [(g, None if r.random() < 0.1 else float(r.randrange(n))) for g, n in (("a", 10), ("b", 10**6), (None, 3)) for _ in range(2000)]
    rows += [("one", 4.5), ("none", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for accuracy in (100_000, 50):
        got = {x.g: (x.n, x.median) for x in exact_median(df, ["g"], "v", accuracy=accuracy, marks=7).collect()}
        for g in {g for g, _ in rows}:
            values = [v for k, v in rows if k == g and v is not None]
            assert got[g] == (sum(k == g for k, _ in rows), statistics.median(values) if values else None)


def test_orphans(spark, skewed):
    parents = spark.range(1, 100).select(F.col("id").alias("pk"))
    orphans = check_orphans(skewed.select("k"), "k", parents, "pk")
    # every row whose key is 0 or >= 100 is an orphan
    assert orphans.count() == skewed.filter("k = 0 OR k >= 100").count()


def test_unpivot_groups_single_scan(spark):
    df = spark.createDataFrame([(1, 10, 20, 1.0, 2.0)], "m int, a_n int, b_n int, a_x double, b_x double")
    long = unpivot_groups(df, ["m"], "side", [("A", {"n": "a_n", "x": "a_x"}), ("B", {"n": "b_n", "x": "b_x"})])
    assert sorted(tuple(r) for r in long.collect()) == [(1, "A", 10, 1.0), (1, "B", 20, 2.0)]
    assert long._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 1


def test_diff_snapshots(spark):
    prev = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "k string, s string")
    curr = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("d", "x")], "k string, s string")
    got = {r.k: (r.prev_s, r.curr_s, r.change_type) for r in diff_snapshots(prev, curr, ["k"], ["s"]).collect()}
    assert got == {"b": ("x", "y", "changed"), "d": (None, "x", "entered")}


def test_conform_rejects_missing_columns_and_casts_keys(spark):
    from pipewright.sources import schemas

    ok = spark.createDataFrame([(1, "Jan-24")], "month long, advertising string")
    out = schemas.conform(ok.withColumnRenamed("month", "m").withColumn("month", F.lit("Feb-24")),
                          schemas.EXPENSES_ADVERTISING)
    assert out.columns == ["month", "advertising"]
    with pytest.raises(ValueError):
        schemas.conform(spark.createDataFrame([("x",)], "other string"), schemas.EXPENSES_ADVERTISING)
    leads = spark.createDataFrame([(7,)], "lead_id long")
    for f in schemas.LEADS.fields[1:]:
        leads = leads.withColumn(f.name, F.lit(None).cast(f.dataType))
    conformed = schemas.conform(leads, schemas.LEADS)
    assert conformed.schema["lead_id"].dataType.simpleString() == "string"   # integer keys accepted as text
    assert conformed.first().lead_id == "7"


def test_scale_conf_sizes_partitions():
    from pipewright.session import scale_conf

    small = scale_conf(1 << 20, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"            # two per core at least
    big = scale_conf(100 * (1 << 40), total_cores=8000)            # 100 TB on 8,000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
