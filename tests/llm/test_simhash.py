import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pipewright.llm import simhash
from pipewright.llm.common import NO_ID
from pipewright.llm.components import components

from .helpers import ODD, docs_of


def brute_print(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints):
    """prints: (doc, fingerprint); the smallest reachable doc of each row."""
    n = len(prints)
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            if prints[i][0] == prints[j][0] != NO_ID or (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                label[find(i)] = find(j)
    least = {}
    for i in range(n):
        if prints[i][0] != NO_ID:  # a null id names nothing
            least[find(i)] = min(least.get(find(i), prints[i][0]), prints[i][0])
    return [least.get(find(i), NO_ID) for i in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB \t\né中", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == brute_print(text)


def test_anchors_cover():
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 32, 200)
    row, anchor, home = simhash.anchors(x)
    of = {}
    for i, a in zip(row, anchor):
        of.setdefault(int(i), set()).add(int(a))
    homes = {int(i): int(a) for i, a, h in zip(row, anchor, home) if h}
    assert len(homes) == len(x) and all((homes[i] ^ int(v)).bit_count() <= 1 for i, v in enumerate(x))
    assert all((a ^ int(x[i])).bit_count() <= 2 for i, s in of.items() for a in s)
    for i, v in enumerate(x[:40]):  # a neighbour at one bit comes to the home
        for b in range(32):
            _, near, _ = simhash.anchors(np.array([int(v) ^ 1 << b]))
            assert homes[i] in near.tolist()


def linked(spark, prints, **options):
    df = spark.createDataFrame([(d, f if f < 2**63 else f - 2**64) for d, f in prints], "doc long, fp long")
    links = [(r.a, r.b) for r in simhash.links(df, **options).collect()]
    of = dict(prints)
    assert len(links) <= 34 * 2 * len(prints)
    label = {r.a: r.b for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    return [label.get(d, d) for d, _ in prints], of


def test_links_against_all_pairs(spark):
    r = random.Random(4)
    centres = [r.getrandbits(64) for _ in range(30)]
    prints = {}
    for d in range(600):
        f = r.choice(centres)
        for _ in range(r.randrange(0, 7)):
            f ^= 1 << r.randrange(64)
        prints.setdefault(f, d)
    prints = [(d, f) for f, d in prints.items()]
    want = brute_components(prints)
    assert linked(spark, prints)[0] == want
    assert linked(spark, prints, chunk=7)[0] == want  # hot anchors dealt into blocks


def test_links_across_the_sign_bit(spark):
    for bits, linked_too in ((1 << 63, True), (1 << 63 | 1, True), (1 << 63 | 3, True), (1 << 63 | 7, False), (3, True), (7, True), (15, False)):
        for base in (5, 5 | 1 << 63, 2**64 - 1):
            assert (linked(spark, [(1, base), (2, base ^ bits)])[0] == [1, 1]) == linked_too


def test_group(spark):
    r = random.Random(5)
    base = " ".join(f"w{r.randrange(500)}" for _ in range(400))
    rows = ODD + [(100 + i, base.replace("w1", f"v{i}", i % 3)) for i in range(20)] + [(200, base), (201, "other words " * 9), (201, base)]
    # null ids: unrelated texts stay apart, and one that is near a document takes its component
    rows += [(None, "quite another text " * 7), (None, base), (300, "same of a null id " * 5), (None, "same of a null id " * 5)]
    got = sorted(tuple(x) for x in simhash.group(docs_of(spark, rows)).collect())
    prints = [(-(2**63) if i is None else i, brute_print(t)) for i, t in rows]
    want = sorted((d, f if f < 2**63 else f - 2**64, c) for (d, f), c in zip(prints, brute_components(prints)))
    assert got == want


def test_empty(spark):
    assert simhash.group(docs_of(spark, [])).collect() == []


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (301, 300)], "a long, b long")
    assert {(r.a, r.b) for r in components(links).collect()} == {(i, 0) for i in range(1, 201)} | {(301, 300)}
