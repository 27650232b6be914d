import random
import re

from pipewright.llm import decontaminate

from .helpers import ODD, docs_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        size = min(len(v), width)
        wins = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1 if v else 0):
            if tuple(w[i:i + size]) in wins:
                hit.update(range(i, i + size))
                found.add(item)
    return len(w), sorted(hit), sorted(str(x) for x in found if x is not None)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS id", "1 AS hit")


def check(spark, rows, items, **options):
    got = sorted((tuple(r) for r in decontaminate.find(docs_of(spark, rows), bench(spark, items), **options).collect()), key=str)
    want = []
    for i, text in rows:
        n, hit, found = brute(text, items)
        want.append((i, text, n, hit, found))
    assert got == sorted(want, key=str)


def test_against_brute_force(spark):
    r = random.Random(3)
    vocab = ["a", "bb", "Über", "c3", "d"]
    items = [(i, " ".join(r.choices(vocab, k=r.randrange(0, 16)))) for i in range(12)] + [(None, "lonely item"), (50, None), (51, "..."), (3, "a bb a bb")]
    rows = ODD + [(100 + i, " ".join(r.choices([*vocab, "Lonely, item", "-"], k=r.randrange(0, 200)))) for i in range(40)]
    check(spark, rows, items)
    check(spark, rows, items, max_bytes=40)  # many blocks of items


def test_symbols_of_two_code_points():
    r = random.Random(9)
    items = [(i, " ".join(f"w{r.randrange(40)}" for _ in range(14))) for i in range(5)] + [(9, "one two"), (10, None), (11, "-")]
    for text in [t for _, t in items] + [f"x {items[0][1]} y W1 w2 {items[3][1]} one; two", "one", "", None]:
        plain, wide = (decontaminate.Built(items, 10, symbols) for symbols in (10**6, 0))
        assert (plain.per_word, wide.per_word) == (1, 2)
        assert decontaminate.scan(text, plain) == decontaminate.scan(text, wide)
        n, hit, found = brute(text, items)
        assert decontaminate.scan(text, wide) == (n, hit, set(map(int, found)))


def test_symbols_differ_and_are_no_surrogates():
    marks = [decontaminate._symbol(i, 1) for i in (0, 0xD7FE, 0xD7FF, 0xD800, 0xDFFF, 999_999)]
    assert len(set(marks)) == 6 and not any(0xD800 <= ord(m) < 0xE000 for m in marks)


def test_empty_benchmark_and_documents(spark):
    check(spark, ODD, [])
    check(spark, [], [(1, "x y")])


def test_spans_point_into_the_original(spark):
    text = "Überall, THE quick-brown fox! jumps; over. the lazy dog again and 中文 again"
    found = decontaminate.find(docs_of(spark, [(1, text)]), bench(spark, [(1, "the quick brown fox jumps over the lazy dog again")]))
    (row,) = decontaminate.with_spans(found).collect()
    assert [text[a:b] for a, b in row.spans] == ["THE quick-brown fox! jumps; over. the lazy dog again"]
