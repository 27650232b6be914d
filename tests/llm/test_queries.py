import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from pipewright.llm import bpe, decontaminate, line_dedup, queries, simhash

from .helpers import ODD, SF, docs_of, write_tables


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = sorted(c[0] for c in want.description)
    want = sorted(str([r[c] for c in columns]) for r in [dict(zip([d[0] for d in want.description], row)) for row in want.fetchall()])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(str([r[c] for c in columns]) for r in got.collect()) == want


def test_registered():
    names = {k.split("_")[0] for k in __spark_entry__.queries()}
    assert {f"op{n}" for n in range(1, 14)} <= names and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage holds to its operator's decisions, and keeps the columns of documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            kept = {r.doc_id: r.text for r in after.collect()}
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert set(kept.items()) <= set(before.items())
            assert sum(labels.get(i) == 1 for i in kept) >= 0.9 * sum(v == 1 for v in labels.values())
        elif name == "line_dedup":
            want = {r.doc: r.kept for r in line_dedup.drop_lines(docs).collect()}
            assert kept == want
            assert all(r.n_chars == len(r.text) for r in after.collect() if before[r.doc_id] != r.text)
        elif name == "simhash_near_dedup":
            groups = {r.doc: r.component for r in simhash.group(docs).collect()}
            assert set(kept) == set(groups.values())
        elif name == "benchmark_decontamination":
            items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            built = decontaminate.automaton(items, decontaminate.WIDTH)
            assert set(kept) == {i for i, t in before.items() if not decontaminate.scan(t, built)[1]}
        else:
            codec = bpe.Codec(bpe.read_ranks(bpe.vocabulary_path()))
            got = {r.doc_id: r for r in after.collect()}
            assert set(got) == set(before) and all(r.n_tokens == len(r.ids) for r in got.values())
            assert all(b"".join(codec.pieces[i].as_py() for i in got[d].ids) == (t or "").encode() for d, t in list(before.items())[:30])
        docs = after
    run = {r.doc_id: tuple(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == {r.doc_id: tuple(r.ids) for r in docs.collect()}


def test_pipeline_of_odd_rows(spark, tmp_path):
    odd = docs_of(spark, ODD, extra=False)
    folder = write_tables(tmp_path, documents=odd, labels=spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int"),
                          benchmark=spark.createDataFrame([(1, "ÄÖ ß 中文 words"), (None, None)], "item_id long, text string"))
    out = corpus_pipeline.run(spark, folder).collect()
    assert len({r.doc_id for r in out}) == len(out)
    write_tables(tmp_path / "none", documents=odd.limit(0), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                 benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []


def test_pipeline_decides_each_row_of_a_null_id(spark, tmp_path):
    docs = docs_of(spark, [(None, "one two three is in the benchmark"), (None, "clean words only"), (7, "clean too"), (7, "one two three again"), (8, None)], extra=False)
    folder = write_tables(tmp_path, benchmark=spark.createDataFrame([(1, "one two three")], "item_id long, text string"))
    out = corpus_pipeline.decontamination(spark, docs, folder).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == [("7", "clean too"), ("8", None), ("None", "clean words only")]


def test_pipeline_quality_decides_each_row_of_a_null_id(spark, tmp_path):
    good, bad = "calm river stone garden light " * 30, "spam click casino bonus win " * 30
    docs = docs_of(spark, [(i, good if i % 2 else bad) for i in range(400)] + [(None, good), (None, bad)], extra=False)
    folder = write_tables(tmp_path, labels=spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int"))
    out = corpus_pipeline.quality(spark, docs, folder).collect()
    assert [r.text for r in out if r.doc_id is None] == [good]


def test_pipeline_near_duplicates_links_by_fingerprint_only(spark):
    """Rows of one id with other texts all stay, and connect no documents near to them."""
    words = [[f"{c}{k}" for k in range(300)] for c in "abcd"]
    text = [" ".join(w) for w in words]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (1, text[0]), (2, text[1]), (3, text[2]), (3, text[3]), (4, text[2])]
    assert min((simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() for a in text for b in text if a < b) > simhash.BITS
    out = corpus_pipeline.near_duplicates(spark, docs_of(spark, rows, extra=False), SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted([("None", text[0]), ("None", text[1]), ("3", text[2]), ("3", text[3])])
