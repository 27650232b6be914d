import random

import numpy as np

from pipewright.llm import importance, quality_rules
from pipewright.llm.common import NO_ID
from pipewright.llm.textarrays import Texts, raw

from .helpers import ODD, SF, docs_of

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    return [w for w in "".join(" " if c in SPACE else c for c in text or "").split(" ") if w]


def brute_base(text):
    text = text or ""
    w = split(text)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if split(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def base_of(texts):
    import pyarrow as pa

    t = Texts(*raw(pa.array(texts, pa.string())))
    got = quality_rules.base(t, t.words())
    return list(zip(*(got[k].tolist() for k in got)))


def test_base_rules_against_brute_force():
    r = random.Random(8)
    texts = [t for _, t in ODD[:6]] + ["".join(r.choices(["a", "b", " ", " ", "\n", "中", "#", "x y z w v ", "same line\n"], k=r.randrange(0, 60))) for _ in range(400)]
    assert base_of(texts) == [brute_base(t) for t in texts]


def test_calibration_maps_margins_to_frequencies():
    r = np.random.default_rng(2)
    z = r.normal(0, 3, 4000)
    good = r.random(4000) < 1 / (1 + np.exp(-(0.5 * z + 1)))
    a, b = quality_rules.calibrate(z, good)
    assert abs(a - 0.5) < 0.1 and abs(b - 1) < 0.2
    assert quality_rules.calibrate(z, np.ones(4000, bool)) == (1.0, 0.0)


def corpus(r, n=600):
    good = lambda: " ".join(r.choice(["the", "of", "river", "stone", "walk", f"w{r.randrange(300)}"]) for _ in range(r.randrange(20, 120)))
    junk = lambda: " ".join(r.choice(["$$$", "click***", "BUY!!", f"x{r.randrange(50)}###"]) for _ in range(r.randrange(20, 120)))
    return [(i, junk() if i % 6 == 0 else good()) for i in range(n)]


def labels_of(spark, rows, share):
    return spark.createDataFrame([(i, int(i % 6 != 0)) for i, _ in rows if i % share == 0 or i % 6 == 0 and i % 12 == 0] + [(None, 1), (10**9, 0), (5, None)],
                                 "doc_id long, quality int").selectExpr("*", "'x' AS good", "0 AS id")


def test_held_out_accuracy(spark):
    rows = corpus(random.Random(1))
    docs, labels = docs_of(spark, rows), labels_of(spark, rows, 2)
    seen = {r.doc_id for r in labels.collect()}
    kept = {r.id: r.kept for r in quality_rules.judge(docs, quality_rules.fit(docs, labels)).collect()}
    base = dict((i, brute_base(t)[-1]) for i, t in rows)
    held = [i for i, _ in rows if i not in seen and not base[i]]
    assert np.mean([kept[i] == (i % 6 != 0) for i in held]) > 0.97
    assert not any(kept[i] for i in base if base[i])
    kept = {r.doc: r.kept for r in importance.resample(docs, labels).collect()}
    held = [i for i, _ in rows if i not in seen]
    assert np.mean([kept[i] == (i % 6 != 0) for i in held]) > 0.97


def test_odd_rows_and_no_labels(spark):
    docs = docs_of(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules.judge(docs, quality_rules.fit(docs, none)).collect()
    want = sorted((str(i), *brute_base(t)) for i, t in ODD if len(t or "") < 1000)
    assert sorted((str(r.id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got if r.word_chars < 1000) == want
    assert all(r.kept != r.base_failed for r in got)
    assert len(importance.resample(docs, none).where("kept").collect()) == len(ODD)
    empty = docs_of(spark, [])
    assert importance.resample(empty, none).collect() == [] and quality_rules.judge(empty, np.zeros((3 << quality_rules.BITS) + 1)).collect() == []
    one = spark.createDataFrame([(1, 1), (1, 0), (3, 1)], "doc_id long, quality int")
    assert len(importance.resample(docs, one).collect()) == len(ODD)


def test_kth_by_leading_bits(spark):
    r = random.Random(6)
    keys = [r.randrange(1 << 62) for _ in range(300)] + [7, 7, 1 << 40, (1 << 40) + 1]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    for k in (1, 2, 150, 303, 304):
        assert importance.kth(df, k) == sorted(keys, reverse=True)[k - 1]


def test_character_grams():
    import pyarrow as pa

    r = random.Random(12)
    texts = ["".join(r.choices("ab \u00e9\u4e2d\U0001F600", k=r.randrange(0, 12))) for _ in range(200)] + ["abab", "", "\u4e2d\u4e2d\u4e2d\u4e2d"]

    def grams(texts):
        t = Texts(*raw(pa.array(texts, pa.string())))
        return [(int(h), int(of)) for h, of in zip(*t.char_grams(4), strict=True)]

    got, names = grams(texts), {}
    want = [(x[i:i + 4], k) for k, x in enumerate(texts) for i in range(len(x) - 3)]
    assert [of for _, of in got] == [of for _, of in want]
    for (h, _), (gram, _) in zip(got, want, strict=True):
        assert names.setdefault(gram, h) == h
    assert len(set(names.values())) == len(names)
    # a gram's hash doesn't depend on what else is in the batch
    assert all([h for h, _ in grams([x])] == [h for h, of in got if of == k] for k, x in enumerate(texts))


def test_one_row_an_id_comes_to_the_driver(spark):
    rows = corpus(random.Random(2), 60) + [(6, f"other text {k}") for k in range(50)]
    labels = labels_of(spark, rows[:60], 1)
    got = [(r.id, r.text) for r in quality_rules.labelled(docs_of(spark, rows), labels, "doc_id", "text", "quality", 1000).collect()]
    assert len(got) == len({i for i, _ in got}) == 60 and set(got) <= set(rows)


def test_log_weight_and_kept_against_brute_force(spark):
    """Counts, ratios, noise, cut and k as the docstring says, over dicts of buckets."""
    import pyarrow as pa

    rows = corpus(random.Random(3), 120) + [(7, "the of the"), (7, "the of the"), (None, "river"), (300, None), (301, "")]
    docs, labels = docs_of(spark, rows), labels_of(spark, rows[:120], 2)
    marks = {}
    for r in labels.collect():
        if r.doc_id is not None and r.quality is not None:
            marks[r.doc_id] = min(marks.get(r.doc_id, 1), r.quality) > 0
    ids = spark.createDataFrame([(i,) for i in {i for i, _ in rows}], "i long")
    noise = ids.selectExpr("i", f"pmod(xxhash64({importance.SEED}, coalesce(i, {NO_ID})), {1 << 40}) AS u", f"pmod(xxhash64({importance.SEED}, i), {importance.HELD}) = 0 AS held").collect()
    u, held = {r.i: (r.u + 0.5) / (1 << 40) for r in noise}, {r.i: r.held for r in noise}
    found = []
    for _, text in rows:
        index, _ = importance.buckets(Texts(*raw(pa.array([(text or "").lower()], pa.string()))))
        found.append(index.tolist())
    every, target = {}, {}
    for (i, _), of in zip(rows, found, strict=True):
        for b in of:
            every[b] = every.get(b, 0) + 1
            target[b] = target.get(b, 0) + (marks.get(i, False) and not held[i])
    share = sum(target.values()) / sum(every.values())
    ratio = {b: np.log(target[b] + importance.PRIOR) - np.log(every[b] * share + importance.PRIOR) for b in every}
    weight = [importance.LENGTH * sum(ratio[b] for b in of) / (len(of) + importance.REST) for of in found]
    tested = {i: min(w for (j, _), w in zip(rows, weight, strict=True) if j == i) for i in {i for i, _ in rows} if i in marks and held[i]}
    cut = importance.best_cut(np.array(list(tested.values())), np.array([marks[i] for i in tested]))
    k = sum(w >= cut for w in weight)
    key = [w - np.log(-np.log(u[i])) for (i, _), w in zip(rows, weight, strict=True)]
    least = sorted(key, reverse=True)[k - 1]
    want = sorted((str(i), round(w, 6), x >= least - 1e-9) for (i, _), w, x in zip(rows, weight, key, strict=True))
    got = importance.resample(docs, labels).collect()
    assert sorted((str(None if r.doc == NO_ID else r.doc), round(r.log_weight, 6), r.kept) for r in got) == want


def test_ties_at_the_kth_key_are_all_kept(spark):
    rows = [(i, "good river stone") for i in range(20)] + [(100 + i, "$$$ ### click") for i in range(20)] + [(5, "good river stone")] * 30
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)], "doc_id long, quality int")
    got = importance.resample(docs_of(spark, rows), labels).where("doc = 5").collect()
    assert len(got) == 31 and len({(r.log_weight, r.kept) for r in got}) == 1


def test_best_cut_spares_good_rows():
    weight, good = np.array([-9.0, -5, -4, 1, 2, 3]), np.array([False, False, True, True, True, True])
    assert -5 < importance.best_cut(weight, good) < -4


def test_small_tables_keep_good_labelled_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_rules.op5_quality_rules(spark, SF).join(labels, "doc_id").toPandas()
    good = got[(got.quality == 1) & ~got.base_failed]
    assert good.kept.mean() > 0.95
