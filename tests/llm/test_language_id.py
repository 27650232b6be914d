import random
import unicodedata

import numpy as np
import pytest

from pipewright.llm import language_id

from .helpers import DOCS, EXTRA, ODD, SF, docs_of, write_tables


def brute_grams(text):
    words, now = [], ""
    for c in (text or "").lower():
        if unicodedata.category(c)[0] in "LM":
            now += c
        elif now:
            words, now = [*words, now], ""
    padded = [f" {w} " for w in [*words, now] if w]
    return [tuple(map(ord, w[k:k + 3])) for w in padded for k in range(len(w) - 2)]


def code(gram):
    a, b, c = gram
    return a << 42 | b << 21 | c


TEXTS = [None, "", "a", "The cat's HAT.", "12 - 3!", "ÄÖ ß 中文 \U0001F600 'll don't", "İstanbul I", "\n\n x\ny ", "नमस्ते दुनिया", "́", "z" * 500, "tail"]


def test_ngrams_against_brute_force():
    grams, of, some = language_id.ngrams(TEXTS)
    assert [(int(t), int(g)) for g, t in zip(grams, of)] == [(k, code(g)) for k, t in enumerate(TEXTS) for g in brute_grams(t)]
    assert some.tolist() == [any(unicodedata.category(c)[0] == "L" for c in t or "") for t in TEXTS]


def test_filter_has_every_member_and_few_others():
    """No false no; false yes at the rate that the correction takes off."""
    r = np.random.default_rng(5)
    sets = [r.integers(0, 1 << 60, n) for n in (0, 300, 3000, *[500] * 9)]
    found = language_id.Filter.build([f"l{k}" for k in range(12)], sets, size=1 << 13, hashes=3)
    strange = r.integers(0, 1 << 60, 40_000)
    for k, own in enumerate(sets):
        mask = lambda grams: found.masks(grams)[:, k // 8] >> k % 8 & 1  # noqa: E731, B023
        assert len(own) == 0 or mask(own).all()
        assert abs(mask(strange).mean() - found.wrong[k]) < 0.02
    mixed = np.concatenate((sets[2][:2000], strange[:2000]))
    n, shares = found.shares(mixed, np.repeat([0, 2], 2000), 3)
    assert n.tolist() == [2000, 0, 2000]
    assert shares[0][2] == 1 and shares[2][2] < 0.05 and not shares[1].any()


def test_shares_do_not_depend_on_steps(monkeypatch):
    r = np.random.default_rng(6)
    found = language_id.Filter.build(["a", "b"], [np.arange(50), np.arange(30, 90)], size=1 << 9, hashes=2)
    grams, of = r.integers(0, 120, 500), np.sort(r.integers(0, 7, 500))
    want = found.shares(grams, of, 8)
    monkeypatch.setattr(language_id, "_BITS", 40)
    got = found.shares(grams, of, 8)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def brute_sets(rows, rare):
    counts = {}
    for lang, text in rows:
        if lang is not None and text is not None:
            for g in brute_grams(text):
                counts.setdefault(lang, {}).setdefault(g, 0)
                counts[lang][g] += 1
    return {x: {code(g) for g, n in c.items() if n * rare >= sum(c.values())} for x, c in counts.items()}


def test_learns_the_common_ngrams_of_each_language(spark):
    r = random.Random(1)
    rows = [(x, " ".join(r.choices(w.split(), k=r.randrange(0, 40)))) for x, w in
            (("aa", "the cat sat on a mat"), ("bb", "der hund lief im wald"), ("cc", "le chat dort dans sa maison")) for _ in range(60)]
    rows += [(None, "never learned"), ("dd", None), ("ee", "12 34"), ("aa", "the cat")]
    df = spark.createDataFrame(rows, "lang string, text string")
    found = language_id.learn(df, rare=25)
    sets = brute_sets(rows, 25)
    assert found.langs == ["aa", "bb", "cc"]
    want = language_id.Filter.build(found.langs, [np.array(sorted(sets[x])) for x in found.langs])
    assert (found.slices == want.slices).all() and (found.wrong == want.wrong).all()
    out = language_id.predict(spark.createDataFrame([(1, "the mat"), (2, "der wald"), (3, "sa maison"), (4, "7"), (5, None)], "doc_id long, text string"), found)
    assert {r.id: r.lang for r in out.collect()} == {1: "aa", 2: "bb", 3: "cc", 4: "und", 5: "und"}


def test_held_out_documents(spark):
    """Nearly all held-out documents of sf0.001 are told right, and none but the training ones count."""
    got = {r.doc_id: r for r in language_id.op12_language(spark, SF).collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got) == set(lang) and all(0 <= r.score <= 1 for r in got.values())
    held = [r for r in got.values() if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_rows(spark, tmp_path, labelled):
    df = docs_of(spark, ODD + [(20, "12 34 -"), (21, "́")])
    for name in ("gram", "score", "lang_pred"):
        df = df.selectExpr("*", f"'x' AS {name}")
    if not labelled:
        df = df.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "source", "n_chars", *EXTRA)
    got = language_id.op12_language(spark, write_tables(tmp_path, documents=df)).collect()
    assert len(got) == len(ODD) + 2
    none = {1, 2, 5, 20, 21}
    assert all((r.lang_pred == "und") == (not labelled or r.doc_id in none) and (r.lang_pred != "und" or r.score == 0) for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}


def test_empty(spark, tmp_path):
    folder = write_tables(tmp_path, documents=spark.createDataFrame([], DOCS))
    assert language_id.op12_language(spark, folder).collect() == []


def test_ties_go_to_the_language_with_more_documents(spark):
    rows = [("b", "same")] * 3 + [("a", "same")] * 2 + [("c", "same")] * 3
    found = language_id.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert found.langs == ["b", "c", "a"] and found.predict(["same", "zzz"])[0] == ["b", "b"]
