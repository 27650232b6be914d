import hashlib
import string

from pipewright.llm import line_dedup

from .helpers import ODD, docs_of

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    key = lambda line: line.strip(SPACE).translate(low)
    ids = lambda i: -(2**63) if i is None else i
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(ids(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == ids(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    from pyspark.sql import functions as F

    from pipewright.llm.common import null_id

    got = line_dedup.drop_lines(docs_of(spark, rows)).select(null_id(F.col("doc")), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256))
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_lines_against_brute_force(spark):
    line = "This line IS in many documents, Élan"
    rows = ODD + [(20 + i, f"own {i}\n  {line.lower() if i % 2 else line}\t\nlast\n{line}") for i in range(6)]
    rows += [(40, "the same short"), (41, "the same short"), (42, "the same short"), (43, line + "\n"), (None, line)]
    assert run(spark, rows) == brute(rows)


def test_exactly_min_docs_and_twenty_characters(spark):
    rows = [(i, "x" * n + "\n") for n in (19, 20) for i in range(3)] + [(9, "y" * 25), (10, "Y" * 25)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_no_python_on_the_main_path(spark):
    plan = line_dedup.drop_lines(docs_of(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
