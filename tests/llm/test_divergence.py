import random
import re

import numpy as np
import pyarrow as pa

from pipewright.llm import divergence

from .helpers import DOCS, EXTRA, ODD, docs_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, min_docs, top):
    """docs: (text, lang, source)."""
    counts, holders, groups = {}, {}, set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        for w in words:
            counts[lang, source, w] = counts.get((lang, source, w), 0) + 1
        for w in set(words):
            holders[lang, w] = holders.get((lang, w), 0) + 1
    out = []
    for lang in {x for x, _ in groups}:
        kept = [w for (x, w), n in holders.items() if x == lang and n >= min_docs]
        sources = [s for x, s in groups if x == lang]
        n = {s: {w: counts.get((lang, s, w), 0) for w in kept} for s in sources}
        both = {w: sum(n[s][w] for s in sources) for w in kept}
        p = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        share, q = {s: p(n[s]) for s in sources}, p(both)
        for s in sources:
            pairs = [(sum(abs(share[s][w] - share[o][w]) for w in kept), o) for o in sources if o != s]
            terms = [(share[s][w] - q[w], w) for w in kept if n[s][w] and share[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def corpus(n=300, seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ka", "lo", "MI", "é", "中") for b in ("rä", "to", "num", "x'y", "st", "ve", "l", "Z")]
    docs = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{r.randrange(6)}"
        weight = [1 + (hash_of(w + source) % 7) for w in words]
        docs.append((" ".join(r.choices(words, weight, k=r.randrange(0, 60))), r.choice(["en", "de", "", None]), source))
    return docs + [(None, "en", "empty"), ("", "xx", "a"), ("once", "xx", "b"), ("1 2 -", None, None)]


def hash_of(text):
    return sum((k + 1) * b for k, b in enumerate(text.encode()))


def frame(spark, docs):
    df = spark.createDataFrame([(i, t, x, s, 0) for i, (t, x, s) in enumerate(docs)], DOCS)
    for name in (*EXTRA, "term", "item", "value", "rank", "docs", "a", "b", "p", "z", "block"):
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def test_against_brute_force(spark):
    docs = corpus()
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, docs), 5, 7, block=2).collect())
    assert got == brute(docs, 5, 7)
    assert {r[2] for r in got} == {"pair", "term"} and len({r[0] for r in got}) == 4
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, docs)).collect())
    assert got == brute(docs, 30, 50)


def test_odd_rows(spark):
    rows = [(t, "en", "s") for _, t in ODD] * 2 + [("word " * 3, "en", "t")] * 3
    got = divergence.audit(docs_of(spark, ODD).unionByName(docs_of(spark, ODD)).unionByName(
        docs_of(spark, [(90 + i, "word " * 3) for i in range(3)]).selectExpr("doc_id", "text", "lang", "'t' AS source", "n_chars", *[f"`{c}`" for c in EXTRA])), 2, 50)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 2, 50)


def test_empty(spark):
    assert divergence.audit(frame(spark, []).limit(0)).collect() == []


def test_skyband_holds_what_few_dominate():
    r = np.random.default_rng(2)
    for size, high in ((0, 2), (1, 2), (700, 3), (1500, 40), (1500, 10**6)):
        n, lang_n, term = r.integers(0, high, size), r.integers(0, high, size), r.permutation(size)
        over = (n[:, None] >= n) & (lang_n[:, None] <= lang_n) & (term[:, None] < term)
        assert sorted(divergence.skyband(n, lang_n, term, 5)) == np.flatnonzero(over.sum(0) < 5).tolist()


def test_matrix_in_blocks_and_steps(monkeypatch):
    r = np.random.default_rng(3)
    size, terms = 8, 40
    z = r.integers(1, 9, size)
    there = r.random((terms, size)) < 0.4
    there[:, 7] = False  # a source without any term
    p = np.where(there, r.integers(1, 99, (terms, size)), z)
    term, who = np.nonzero(there)
    some = there.any(1)
    want = {(a, b): int(np.abs(p[some][:, a] - p[some][:, b]).sum() - some.sum() * abs(z[a] - z[b])) for a in range(size) for b in range(size)}
    for cells in (1, 50, 1 << 20):
        monkeypatch.setattr(divergence, "_CELLS", cells)
        a, b, v = divergence.matrix_rows(z, np.arange(size) < 3, who, term, p[term, who], False)
        assert dict(zip(zip(a.tolist(), b.tolist()), v.tolist())) == {k: x for k, x in want.items() if k[0] < 3 <= k[1] and x}
        a, b, v = divergence.matrix_rows(z, np.ones(size, bool), who, term, p[term, who], True)
        assert dict(zip(zip(a.tolist(), b.tolist()), v.tolist())) == {k: x for k, x in want.items() if k[0] < k[1] and x}


def test_long_runs_are_compared_in_parts(monkeypatch):
    rows = [("l", 0, 0, 0, 0, f"s{s}", "", 2 + s, 2 + s) for s in range(5)]
    rows += [("l", 0, 0, 0, 0, f"s{s}", f"t{t:03}", 5 + s * t % 11, 2 + s) for t in range(60) for s in range(4) if (s + t // 20) % 3]
    names = ["lang", "lo", "hi", "part", "block", "source", "term", "p", "z"]
    table = pa.table([pa.array(c) for c in zip(*rows)], names=names)

    def total(held, size):
        monkeypatch.setattr(divergence, "_HELD", held)
        out = {}
        for batch in divergence._matrices(iter(table.to_batches(max_chunksize=size))):
            for r in batch.to_pylist():
                k = tuple(sorted((r["a"], r["b"])))
                out[k] = out.get(k, 0) + r["value"]
        return {k: v for k, v in out.items() if v}

    assert total(10, 3) == total(25, 7) == total(10**6, 7) == total(10**6, 1000) != {}
