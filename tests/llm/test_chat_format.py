import random

from pipewright.llm import chat_format


def brute(rows):
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((t, r, x))
    null_first = lambda v: tuple((x is not None, x or 0 if not isinstance(x, str) else x) for x in v)
    seqs = {c: tuple((r, x) for _, r, x in sorted(v, key=null_first)) for c, v in convs.items()}
    proper = {s[:k] for s in seqs.values() for k in range(1, len(s))}
    least = {}
    for c, s in seqs.items():
        if s not in proper:
            least[s] = min(least.get(s, (True, 0)), (c is not None, c or 0)) if s in least else (c is not None, c or 0)
    return sorted((str(c if has else None), len(s), "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in s)) for s, (has, c) in least.items())


def run(spark, rows):
    from pyspark.sql import functions as F

    from pipewright.llm.common import null_id

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS conv", "1 AS k", "2 AS h1")
    return sorted((str(r.c), r.n_turns, r.text) for r in chat_format.render(df).select(null_id(F.col("conv")).alias("c"), "n_turns", "text").collect())


def test_against_brute_force(spark):
    r = random.Random(7)
    long = [[(k, r.choice(["user", "assistant"]), r.choice(["a", "b", "", "c\nd"])) for k in range(r.randrange(1, 7))] for _ in range(25)]
    rows, c = [], 0
    for s in long:
        for k in {r.randrange(1, len(s) + 1), len(s), r.randrange(1, len(s) + 1)}:
            c += 1
            rows += [(c, *t) for t in s[:k]] * r.choice([1, 1, 2])
    rows += [(None, 0, "user", "alone"), (900, 0, None, "x"), (901, 0, "", "x"), (902, 0, None, None), (903, None, "user", "n")]
    assert run(spark, rows) == brute(rows)


def test_position_counts_and_empty(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "a"), (2, 0, "user", "a"), (3, 0, "user", "b"), (3, 1, "user", "a")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
