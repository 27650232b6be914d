r"""Quality classifier by importance resampling.

Two generative models of hashed words and word pairs: the target, from documents
labelled good, and the raw, from all documents.  A document's log weight is the
mean over its n-grams of log(target / raw), for ``LENGTH`` of them (so that long
texts don't gather small biases; short ones are drawn to 0); Gumbel noise, fixed by
the id, is added and the top k documents are kept.  k is not set by hand: it is the number of
documents whose log weight reaches the cut that best parts the labelled rows that
the target has not seen (one in ``HELD``, by id hash).

Defined results: a null or empty text has log weight 0; rows of one id share the
noise; ties at the k-th key are all kept; a document with several labels counts
as good only if all are; of several rows of a held id the smallest log weight counts
for the cut; without labels of both kinds everything is kept.

Scale: one pass for the counts, one row of ``2^BITS`` counts a task to the
aggregation; one pass for the weights, stored as (id, weight, key) rows; the k-th
key is found by counting on the keys' leading bits, four rounds of at most 2^16
groups, so nothing is sorted.  The target and the cut are fitted on at most
``SAMPLE`` labelled documents, of whose held ids one number each comes to the driver;
the raw counts cover every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_key, null_id, row_key, sliced, stored, table
from .textarrays import Texts, chain, lower, raw, within

SAMPLE, BITS, SEED, HELD = 20_000, 15, 7, 5
PRIOR = 3.0
LENGTH, REST = 100, 20
GOOD_WEIGHT = 3.0


def buckets(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word and pair of words."""
    start, end, text = t.words()
    hashes = t.hashes(start, end)
    pair = within(text, 2)
    shift = np.uint64(64 - BITS)
    return (np.concatenate((hashes >> shift, chain(hashes, pair, 2) >> shift)).astype(np.int64), np.concatenate((text, text[pair])))


def _texts(batch: pa.RecordBatch) -> Texts:
    data, at = raw(batch.column("text"))
    return Texts(lower(data), at)


def counts(marked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bucket counts of all rows, and of the ``good`` ones, of (text, good)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for batch in sliced(batches, "text"):
            index, of = buckets(_texts(batch))
            good = batch.column("good").to_numpy(zero_copy_only=False)[of]
            every += np.bincount(index, minlength=1 << BITS)
            target += np.bincount(index[good], minlength=1 << BITS)
        at = np.flatnonzero(every)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(every[at]), pa.array(target[at])], names=["bucket", "n", "t"])

    got = marked.mapInArrow(run, "bucket long, n long, t long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toPandas()
    every, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    every[got.bucket], target[got.bucket] = got.n, got.t
    return every, target


def best_cut(weight: np.ndarray, good: np.ndarray) -> float:
    """The cut that parts best; losing a good row counts ``GOOD_WEIGHT`` times; among equal ones midway."""
    order = np.argsort(weight, kind="stable")
    x, y = weight[order], good[order]
    # with the cut before i: the good ones from i on and the others before i are right
    others = np.concatenate(([0], np.cumsum(~y))) / (~y).sum()
    lost = np.concatenate(([0], np.cumsum(y))) / y.sum()
    right = others - GOOD_WEIGHT * lost
    at = np.flatnonzero(right >= right.max() - 1e-12)
    edge = np.concatenate(([x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]))
    return float(edge[at[len(at) // 2]])


def sortable(column: Column) -> Column:
    """Of a key in [-2^40, 2^40], a non-negative long in the same order."""
    return F.floor((F.greatest(F.least(column, F.lit(2.0**40)), F.lit(-(2.0**40))) + F.lit(2.0**40)) * F.lit(2.0**22)).cast("long")


def kth(keys: DataFrame, k: int) -> int:
    """The k-th largest of the longs ``key`` (under 2^64 / 2), by its leading bits."""
    low, left = 0, k
    for shift in (48, 32, 16, 0):
        parts = keys.where((F.col("key") >= low) & (F.col("key") <= low + (1 << shift + 16) - 1 if shift < 48 else F.lit(True))) \
            .groupBy(F.shiftright("key", shift).alias("part")).count().orderBy(F.desc("part")).collect()
        for part, n in parts:
            if n >= left:
                break
            left -= n
        low = part << shift
    return low


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             sample: int = SAMPLE, seed: int = SEED, rows_apart: bool = False) -> DataFrame:
    """(doc, log_weight, kept) for each row of ``docs``; doc by :func:`common.doc_key`.

    ``rows_apart`` adds row, by :func:`common.row_key`.
    """
    row = ["row"] if rows_apart else []
    source = docs.select(doc_key(F.col(id_col)).alias("doc"), F.col(text_col).alias("text"))
    chosen = labels.select(F.col(id_col).cast("long").alias("doc"), (F.col(label_col) > 0).alias("good")).dropna() \
        .groupBy("doc").agg(F.min("good").alias("good")).orderBy(F.xxhash64("doc"), "doc").limit(sample) \
        .withColumn("held", F.pmod(F.xxhash64(F.lit(seed), "doc"), F.lit(HELD)) == 0)
    chosen = F.broadcast(stored(chosen, "labels"))
    marked = source.join(chosen, "doc", "left")
    every, target = counts(marked.select("text", F.coalesce(F.col("good") & ~F.col("held"), F.lit(False)).alias("good")))
    # both models smoothed by PRIOR n-grams a bucket as the raw model deals them: what is rare says little
    expected = every * (target.sum() / max(every.sum(), 1))
    ratio = np.log(target + PRIOR) - np.log(expected + PRIOR)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            t = _texts(batch)
            index, of = buckets(t)
            passed = ["doc", "good", "held", *row]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(LENGTH * np.bincount(of, shared.value[index], t.n) / (np.bincount(of, minlength=t.n) + REST))],
                                             names=[*passed, "log_weight"])

    # Gumbel noise -log(-log u) with u from the id's hash, strictly between 0 and 1
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc"), F.lit(1 << 40)) + 0.5) / F.lit(float(1 << 40))
    weighed = stored(marked.select("doc", "good", "held", *[row_key(F.col("text")).alias(c) for c in row], "text")
                     .mapInArrow(run, f"doc long, good boolean, held boolean, {'row long, ' if row else ''}log_weight double")
                     .withColumn("key", sortable(F.col("log_weight") - F.log(-F.log(u)))), "weights")
    rows = weighed.where("held").groupBy("doc", "good").agg(F.min("log_weight").alias("log_weight")).toPandas()
    good = rows.good.to_numpy(bool)
    if not len(good) or good.all() or not good.any():
        return weighed.select("doc", *row, "log_weight", F.lit(True).alias("kept"))
    k = weighed.where(F.col("log_weight") >= best_cut(rows.log_weight.to_numpy(), good)).count()
    least = kth(weighed, k) if k else 1 << 62
    return weighed.select("doc", *row, "log_weight", (F.col("key") >= least).alias("kept"))


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(null_id(F.col("doc")).alias("doc_id"), "log_weight", "kept")
