r"""Quality rules: heuristic base rules, then a hashed n-gram logistic regression.

The model sees relative frequencies of hashed character 4-grams, words and word pairs.
It is fitted on a bounded sample of labelled rows (at most ``SAMPLE`` documents,
those with the smallest id hash), four fifths to fit and one fifth to calibrate
(Platt scaling); the calibrated probability of good quality is held against a
fixed threshold.  Texts are scored whole, in Arrow batches.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows are judged each for itself; a document with several labels counts
as good only if all are; of several texts of a labelled id the one with the smallest
hash is learned from; labels without an id or a value are left out; without
labels of both kinds the model keeps what the base rules keep.

Scale: documents are streamed through once more after the fit, without a
shuffle.  The ids of the sample (bounded) are broadcast to pick its documents, one
row an id, each task keeping one; their hashed features come to the driver (SAMPLE
rows at most); the weights (fixed size) go out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key, sliced, table
from .textarrays import Texts, chain, raw, within

SAMPLE, KEEP_FROM = 4000, 0.5
BITS, GRAM = 16, 4
MIN_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
_SCALE = (60.0, 20.0, 20.0)
_STEPS, _RATE, _DECAY = 150, 0.05, 1e-4
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def features(t: Texts, words: tuple | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For character grams, words and word pairs: (index of the weight, text)."""
    start, end, text = words or t.words()
    hashes = t.hashes(start, end)
    pair = within(text, 2)
    kinds = (t.char_grams(GRAM), (hashes, text), (chain(hashes, pair, 2), text[pair]))
    return [((h >> np.uint64(64 - BITS)).astype(np.int64) + (k << BITS), of) for k, (h, of) in enumerate(kinds)]


def margin(found: list, weights: np.ndarray, n: int) -> np.ndarray:
    """The model's value of each of n texts: per kind a mean of weights."""
    out = np.full(n, weights[-1])
    for scale, (index, of) in zip(_SCALE, found, strict=True):
        count = np.bincount(of, minlength=n)
        out += scale * np.bincount(of, weights[index], n) / np.maximum(count, 1)
    return out


def base(t: Texts, words: tuple) -> dict[str, np.ndarray]:
    start, end, text = words
    n_words = np.bincount(text, minlength=t.n)
    hashes = t.hashes(start, end)
    first = within(text, WINDOW)
    _, group, size = np.unique(chain(hashes, first, WINDOW) ^ text[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15),
                               return_inverse=True, return_counts=True)
    twice = first[size[group] > 1]
    mark = np.zeros(len(text) + 1, np.int64)
    np.add.at(mark, twice, 1)
    np.add.at(mark, twice + WINDOW, -1)
    repeated = np.bincount(text[np.cumsum(mark)[:-1] > 0], minlength=t.n)
    a, b, of = t.lines()
    inside = np.concatenate(([0], np.cumsum(~t.space)))
    with_word = inside[b] > inside[a]
    a, b, of = a[with_word], b[with_word], of[with_word]
    key = t.hashes(a, b) ^ of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, kept = np.unique(key, return_index=True)
    return {"n_words": n_words, "word_chars": t.per_text(~t.space & ((t.data & 0xC0) != 0x80)), "n_symbols": t.per_text(_SYMBOL[t.data]),
            "n_dup_lines": np.bincount(of, minlength=t.n) - np.bincount(of[kept], minlength=t.n), "n_repeat_words": repeated,
            "base_failed": (n_words < MIN_WORDS) | (100 * repeated > REPEAT_PERCENT * n_words)}


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """(id, text, good) of at most ``sample`` labelled documents, one row each."""
    chosen = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("good")).dropna() \
        .groupBy("id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("id"), "id").limit(sample)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id") \
        .groupBy("id", "good").agg(F.min_by("text", row_key(F.col("text"))).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> np.ndarray:
    """Weights, and the intercept at the end, with the calibration worked in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            t = Texts(*raw(batch.column("text")))
            found = features(t)
            index, value = [[] for _ in range(t.n)], [[] for _ in range(t.n)]
            for scale, (i, of) in zip(_SCALE, found, strict=True):
                cell, size = np.unique(of * (4 << BITS) + i, return_counts=True)
                each = cell // (4 << BITS)
                count = np.bincount(of, minlength=t.n)
                cut = np.searchsorted(each, np.arange(t.n + 1))
                for k in range(t.n):
                    part = slice(cut[k], cut[k + 1])
                    index[k].append((cell[part] % (4 << BITS)).astype(np.int32))
                    value[k].append((scale * size[part] / max(count[k], 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("good"), pa.array(list(map(np.concatenate, index)), pa.list_(pa.int32())),
                                              pa.array(list(map(np.concatenate, value)), pa.list_(pa.float32()))], names=["id", "good", "index", "value"])

    got = labelled(docs, labels, id_col, text_col, label_col, sample).mapInArrow(run, "id long, good int, index array<int>, value array<float>").toArrow()
    got = got.take(pc.sort_indices(got, sort_keys=[("id", "ascending")])).combine_chunks()
    size = 3 << BITS
    weights, good = np.zeros(size + 1), got.column("good").to_numpy() > 0
    if not len(good) or good.all() or not good.any():
        weights[-1] = 50.0  # nothing to tell apart: keep
        return weights
    row = np.repeat(np.arange(len(good)), pc.list_value_length(got.column("index")).to_numpy())
    index = got.column("index").combine_chunks().flatten().to_numpy().astype(np.int64)
    value = got.column("value").combine_chunks().flatten().to_numpy().astype(np.float64)
    held = np.arange(len(good)) % 5 == 0
    weigh = np.where(good, 0.5 / max(good[~held].sum(), 1), 0.5 / max((~good[~held]).sum(), 1)) * ~held
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, _STEPS + 1):
        z = np.bincount(row, weights[index] * value, len(good)) + weights[-1]
        error = (1 / (1 + np.exp(-z)) - good) * weigh
        slope = np.append(np.bincount(index, error[row] * value, size) + _DECAY * weights[:-1], error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= _RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    z = np.bincount(row, weights[index] * value, len(good)) + weights[-1]
    a, b = calibrate(z[held], good[held])
    weights *= a
    weights[-1] += b
    return weights


def calibrate(z: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Platt scaling: (a, b) for the probability 1 / (1 + exp(-(a z + b)))."""
    if not len(z) or good.all() or not good.any():
        return 1.0, 0.0
    # smoothed targets, as few rows could otherwise be parted with certainty
    aim = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    x, found = np.stack([z, np.ones_like(z)], 1), np.array([0.0, np.log(good.mean() / (1 - good.mean()))])
    loss = lambda f: (np.logaddexp(0, x @ f) - aim * (x @ f)).mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-6 * np.eye(2), x.T @ (p - aim))
        while loss(found - step) > loss(found) and np.abs(step).max() > 1e-9:
            step = step / 2
        found = found - step
    # a wrong sign can only come from a few odd rows: then leave the margin as it is
    return (float(found[0]), float(found[1])) if found[0] > 0 else (1.0, 0.0)


SCHEMA = ("id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "probability double, kept boolean")


def judge(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """A row of :data:`SCHEMA` for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1 << 20):
            t = Texts(*raw(batch.column("text")))
            words = t.words()
            out = base(t, words)
            p = 1 / (1 + np.exp(-np.clip(margin(features(t, words), shared.value, t.n), -500, 500)))
            out |= {"probability": p, "kept": ~out["base_failed"] & (p >= keep_from)}
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, out.values())], names=["id", *out])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")
