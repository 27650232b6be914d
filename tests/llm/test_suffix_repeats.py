import hashlib
import random

import numpy as np

from pipewright.llm import suffix_repeats

from .helpers import ODD, docs_of


def brute(rows, length):
    ids = lambda i: -(2**63) if i is None else i
    raws = [(ids(i), (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in raws:
        for k in range(len(t) - length + 1):
            w = t[k:k + length]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, t in raws:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if least[t[k:k + length]] < i:
                gone[k:k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out)


def run(spark, rows, **options):
    got = suffix_repeats.remove_repeats(docs_of(spark, rows), **options).selectExpr("doc", "n_bytes", "n_removed", "size(spans)", "kept_sha256")
    return sorted(tuple(r) for r in got.collect())


def test_against_brute_force(spark):
    r = random.Random(9)
    passage = ["".join(r.choices("abcdefgh é", k=r.randrange(30, 200))) for _ in range(6)]
    rows = [(i, "".join(r.choice(passage) if r.random() < 0.4 else "".join(r.choices("abcdefgh ", k=r.randrange(60))) for _ in range(6))) for i in range(60)]
    r.shuffle(rows)
    small = [(i, t) for i, t in ODD if len(t or "") < 1000]
    want = brute(rows + small, 50)
    assert run(spark, rows + small) == want
    assert run(spark, rows + small, block=2000, part=3000) == want  # many blocks and parts


def test_long_texts_of_one_letter(spark):
    rows = [(1, "z" * 3000), (2, "z" * 2000), (2, "z" * 49), (3, "y" * 60 + "z" * 50)]
    assert run(spark, rows) == brute(rows, 50)


def test_many_copies_of_a_passage(spark):
    r = random.Random(2)
    passage = "".join(r.choices("abcdefgh ", k=300))
    rows = [(i, f"{i} {r.random()}{passage}{r.random()} {i}") for i in range(300)]
    assert run(spark, rows, block=5000) == brute(rows, 50)


def test_hot_anchors_in_many_contexts(spark):
    """A passage in many documents, each with text of its own around it; some contexts repeat in part."""
    r = random.Random(5)
    passage, around = "".join(r.choices("abcdefgh ", k=120)), ["".join(r.choices("stuvw ", k=40)) for _ in range(5)]
    rows = [(i, f"{r.random()}{r.choice(around)}{passage}{r.choice(around)}{r.random()}") for i in range(150)] + [(None, passage), (151, passage * 2)]
    rows += rows[:20]  # repeated rows
    r.shuffle(rows)
    want = brute(rows, 50)
    for hot in (0, 5, 100):  # all anchors hot, the shared ones, the hottest
        assert run(spark, rows, block=4000, part=9000, hot=hot) == want
    assert run(spark, rows, hot=3) == want  # one block


def test_empty_table_and_extremes(spark):
    assert run(spark, []) == []
    assert len(run(spark, ODD)) == len(ODD)


def test_interval_tree():
    depth, low, high = suffix_repeats.intervals(np.array([0, 3, 5, 5, 2, 0, 4]))
    assert set(zip(depth.tolist(), low.tolist(), high.tolist())) == {(5, 1, 3), (3, 0, 3), (2, 0, 4), (4, 5, 6)}


def test_maximal_repeats_have_all_occurrences():
    a, b = b"the quick brown fox jumps", b"a quick brown fox sleeps, "
    data = np.frombuffer(a + b, np.uint8)
    first, last = np.array([0, len(a)]), np.array([len(a) - 10, len(a) + len(b) - 10])
    position, _, depth, low, high = suffix_repeats.maximal_repeats(data, first, last, 10)
    groups = {bytes(data[position[i]:position[i] + d]): sorted(position[i:j + 1].tolist()) for d, i, j in zip(depth, low, high)}
    assert groups == {b" quick brown fox ": [3, len(a) + 1]}
