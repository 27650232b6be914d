import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipewright.llm import attention_lm as lm

from .helpers import ODD, SF, docs_of


def words(text):
    return (text or "").encode().lower().split()


def brute(rows):
    c, ends = collections.Counter(), 0
    learn = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1
    for i, t in rows:
        if learn(i):
            c.update(words(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + bool(ends)
    out = []
    for i, t in rows:
        counts = [c.get(w, 0) for w in words(t)] + [ends]
        out.append((i, not learn(i), len(counts), sum(x > 0 for x in counts), n, sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in counts)))
    return out


def check(got, want):
    got, want = (sorted(x, key=lambda r: (str(r[0]), r[2:])) for x in (got, want))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert all(math.isfinite(r[6]) and r[6] <= 0 for r in got)


def test_counts_and_base_score(spark, monkeypatch):
    rows = ODD + [(100 + i, f"Alpha beta {i % 7} gamma\tdelta x{i}") for i in range(80)]
    want = brute(rows)
    check([tuple(r) for r in lm.score(docs_of(spark, rows)).collect()], want)
    monkeypatch.setattr(lm, "HOT", 3)  # nearly all words by the join
    check([tuple(r) for r in lm.score(docs_of(spark, rows)).collect()], want)


def test_empty_and_without_training(spark):
    assert lm.score(docs_of(spark, [])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    check([tuple(r) for r in lm.score(docs_of(spark, [(held, "a b")])).collect()], brute([(held, "a b")]))


@pytest.mark.parametrize("n", [300, 62_000])
def test_rounds_learn_from_every_training_document(spark, monkeypatch, n):
    seen = []

    def round_of(_, part, model):
        seen.extend(r.text for r in part.select("text").collect())
        return model.weights

    monkeypatch.setattr(lm, "_round", round_of)
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    lm.fit(docs)
    assert sorted(seen) == sorted(str(i) for i in range(n) if zlib.crc32(str(i).encode()) % 5 != 1)


def test_model_beats_the_base_on_held_out_text(spark):
    got = lm.op4_attention_lm(spark, SF).where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()


def test_windows_score_each_token_once():
    r = np.random.default_rng(0)
    at = np.cumsum([0, 1, 24, 25, 3, 200])
    ids = r.integers(0, lm.OTHER, at[-1])
    inputs, targets, owner = lm.windows(ids, at)
    assert np.array_equal(targets[targets >= 0], ids)
    for w in range(len(inputs)):
        text = ids[at[owner[w]]:at[owner[w] + 1]]
        begin = (np.flatnonzero(owner == owner[w]).tolist().index(w)) * lm._SCORED
        for k, place in enumerate(range(begin - lm.CONTEXT, begin + lm._SCORED)):
            want = -1 if place < 0 or place >= len(text) else lm.START if place == 0 else text[place - 1]
            assert inputs[w, k] == want


def test_gradient():
    r = np.random.default_rng(0)
    at = np.array([0, 1, 30, 90])
    inputs, targets, _ = lm.windows(r.integers(0, lm.OTHER, 90), at)
    p = {k: v.astype(np.float64) for k, v in lm.initial(np.ones(lm.IDS)).items()}
    g, places = lm.gradient(p, inputs, targets), list(zip(*np.nonzero(targets >= 0)))

    def loss(q):
        logits = lm.forward(q, inputs)[-1]
        return -sum(logits[a, b, targets[a, b]] - np.log(np.exp(logits[a, b]).sum()) for a, b in places) / len(places)

    for name in p:
        at_ = (inputs[1][lm.CONTEXT + 2], 3) if name == "embed" else tuple(r.integers(0, s) for s in p[name].shape)
        up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
        up[name][at_] += 1e-4
        down[name][at_] -= 1e-4
        assert abs((loss(up) - loss(down)) / 2e-4 - g[name][at_]) < 1e-6


def test_later_ids_change_nothing_before():
    r = np.random.default_rng(1)
    ids = r.integers(0, lm.OTHER, 60)
    p = lm.initial(np.ones(lm.IDS))
    a = lm.log_probabilities(p, *lm.windows(ids, np.array([0, 60]))[:2])
    ids[30:] = 5
    b = lm.log_probabilities(p, *lm.windows(ids, np.array([0, 60]))[:2])
    assert np.allclose(a.ravel()[:30], b.ravel()[:30])
