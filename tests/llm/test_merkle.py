import hashlib
import zlib

import pytest
from pyspark.sql import types as T

from pipewright.llm import merkle
from pipewright.llm.common import null_id  # noqa: F401  (imported as the operators' users do)

from .helpers import DOCS, EXTRA, ODD, write_tables


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(hashes, fanout):
    """(root, for each node its (left, right) siblings to the root)."""
    way, at, now = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(now) > 1:
        for w, i in zip(way, at):
            first = i // fanout * fanout
            w.append(("".join(now[first:i]), "".join(now[i + 1:first + fanout])))
        now = [sha(*now[i:i + fanout]) for i in range(0, len(now), fanout)]
        at = [i // fanout for i in at]
    return now[0], way


def brute(docs, fanout=8):
    """docs: (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in docs:
        own = leaf_of((i, source, lang, n, text))
        cut = text
        if i is not None and text is not None and zlib.crc32(str(i).encode()) % 3 == 0:
            cut = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        groups.setdefault((lang is not None, (lang or "").encode()), []).append((i is not None, i or 0, own, i, leaf_of((i, source, lang, n, cut))))
    order = sorted(groups)
    trees = {g: climb([x[2] for x in sorted(groups[g])], fanout) for g in order}
    root, tops = climb([trees[g][0] for g in order], fanout) if order else (None, [])
    out = []
    for g, top in zip(order, tops):
        for (_, _, own, i, changed), way in zip(sorted(groups[g]), trees[g][1]):
            folded = changed
            for left, right in way + top:
                folded = sha(left, folded, right)
            out.append((i, own, trees[g][0], root, sha(*[x for step in way + top for x in step]), folded, folded == root))
    return sorted(out, key=str)


def run(spark, tmp_path, docs):
    df = spark.createDataFrame(docs, DOCS)
    for name in (*EXTRA, "g", "h", "i", "path", "root"):
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    got = merkle.op11_merkle(spark, write_tables(tmp_path, documents=df))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_brute_force(spark, tmp_path):
    """Groups of 1, 8, 9, 64, 65 and 80 leaves, more than eight groups, null and empty columns, repeated ids."""
    docs = [(1000 * k + i, f"Text {i} OF this", lang, None if i % 7 == 0 else f"s{i % 3}", i) for k, (lang, n) in enumerate(
        [("a", 1), ("b", 8), ("c", 9), ("d", 64), ("e", 65), ("f", 80), ("g", 2), ("h", 3), ("é", 4), ("", 5), (None, 7)]) for i in range(n)]
    docs += [(i, t, "en" if i != 1 else None, "s", None) for i, t in ODD]
    docs += [(None, "No ID here", "en", None, 3), (5001, "other TEXT of a repeated id", "f", "s", 1), (5001, "other TEXT of a repeated id", "f", "s", 1)]
    got = run(spark, tmp_path, docs)
    assert got == brute(docs)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("docs", [[], [(7, "A lone LEAF", "en", "s", 11)], [(i, "T", "en", None, None) for i in range(9)]])
def test_small(spark, tmp_path, docs):
    assert run(spark, tmp_path, docs) == brute(docs)


def test_copies_of_one_row_are_dealt_over_parts(spark):
    """A third of all rows alike: none of the parts of the numbering gets them all."""
    df = spark.createDataFrame([("1en", 5 if i % 3 == 0 else i) for i in range(9000)], "g string, id long")
    got = merkle.numbered(merkle.stored(df, "t"), ["id"])
    rows = got.collect()
    assert sorted(r.i for r in rows) == list(range(9000)) and {r.n for r in rows} == {9000}
    assert [r.id for r in sorted(rows, key=lambda r: r.i)] == sorted(r.id for r in rows)


def test_another_fanout_and_proofs_fold(spark):
    schema = T.StructType([T.StructField("g", T.StringType()), T.StructField("id", T.LongType()), T.StructField("h", T.StringType())])
    rows = spark.createDataFrame([("1x" if i % 4 else "1y", i, sha(str(i))) for i in range(40)], schema)
    got = merkle.manifest(rows, fanout=3).collect()
    for r in got:
        h = r.h
        for step in r.path:
            h = sha(step.left, h, step.right)
        assert h == r.root
    x = climb([sha(str(i)) for i in range(40) if i % 4], 3)[0]
    y = climb([sha(str(i)) for i in range(0, 40, 4)], 3)[0]
    assert {r.root for r in got} == {sha(x, y)} and {r.subroot for r in got} == {x, y}
