r"""Benchmark decontamination with one Aho-Corasick automaton.

Items and documents are normalised alike: A-Z lower-cased, words are runs of
digits, letters a-z and all characters from U+0080.  Each item gives its windows
of ``width`` consecutive words (an item of fewer words, but not none, is one
window).  One automaton holds all windows, as strings of a symbol for each different
word; each text is scanned once, words the benchmark lacks as a symbol that no window
has, and the ends of matches are mapped back to offsets of the original text.

Defined results: a null text or item has no words; items of one id are one
item; an item without an id still hits, but is in no list; repeated rows are
judged each for itself; an empty benchmark contaminates nothing.

Scale: documents are only streamed through, without a shuffle.  What goes to
the tasks is the benchmark's text, whose size is checked first: beyond ``max_bytes``
it is dealt into blocks of about that size.  Then the documents pass through the
automaton of one block after the other, so that a task holds one at a time; each pass
stores the rows with a hit (id, hash of the text, hits), and the documents take the
hits of all passes by one join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_key, row_key, stored, table

WIDTH = 10
MAX_BYTES = 2 << 20
# symbols of one code point; a block with more different words takes two for each word
SYMBOLS = 1_000_000
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BUILT: dict = {}


def words_of(text: str | None) -> list[bytes]:
    # only 0x20 is left of the ASCII separators, so split() parts at that alone
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def _symbol(i: int, per_word: int) -> str:
    if per_word == 1:
        return chr(i + 1 if i + 1 < 0xD800 else i + 0x801)  # leaves the surrogates out
    # two alphabets, so that no match begins within a word
    return chr(1 + (i >> 19)) + chr(0x80000 + (i & 0x7FFFF))


class Built:
    """An automaton over words: windows as strings of symbols; values: (number of words, item ids)."""

    def __init__(self, items: list[tuple[str, str]], width: int, symbols: int = SYMBOLS):
        words = [(item_id, words_of(text)) for item_id, text in items]
        vocabulary = dict.fromkeys(w for _, of in words for w in of)
        self.per_word = 1 if len(vocabulary) <= symbols else 2
        self.symbol = {w: _symbol(i, self.per_word) for i, w in enumerate(vocabulary)}
        self.none = "\0" * self.per_word
        found: dict[str, set] = {}
        for item_id, of in words:
            text = self.text(of)
            n = min(len(of), width)
            for i in range(len(of) - n + 1 if of else 0):
                found.setdefault(text[i * self.per_word:(i + n) * self.per_word], set()).add(item_id)
        self.matches = ahocorasick.Automaton()
        for window, ids in found.items():
            self.matches.add_word(window, (len(window) // self.per_word, sorted(x for x in ids if x is not None)))
        self.matches.make_automaton()

    def text(self, words: list[bytes]) -> str:
        symbol, none = self.symbol.get, self.none
        return "".join([symbol(w, none) for w in words])


def automaton(items: list[tuple[str, str]], width: int) -> Built | None:
    built = Built(items, width)
    return built if built.symbol else None


def _cached(shared, width: int):
    if shared.id not in _BUILT:
        _BUILT.clear()
        _BUILT[shared.id] = automaton(shared.value, width)
    return _BUILT[shared.id]


class _Shared:
    """A broadcast with a name for the workers' cache."""

    def __init__(self, spark: SparkSession, items: list):
        self.of = spark.sparkContext.broadcast(items)
        self.id = self.of._jbroadcast.id()

    @property
    def value(self) -> list:
        return self.of.value

    def __getstate__(self):
        return {"of": self.of, "id": self.id}


def scan(text: str | None, built) -> tuple[int, list[int], set]:
    """(words, indices of hit words, ids of items with occurring windows)."""
    words = words_of(text)
    if not words or built is None:
        return len(words), [], set()
    hits: list[tuple[int, int]] = []
    items: set = set()
    for end, (n, ids) in built.matches.iter(built.text(words)):
        hits.append((end, n))
        items.update(ids)
    if not hits:
        return len(words), [], items
    mark = np.zeros(len(words) + 1, np.int64)
    last = (np.array([e for e, _ in hits]) + 1) // built.per_word
    np.add.at(mark, last - [n for _, n in hits], 1)
    np.add.at(mark, last, -1)
    return len(words), np.flatnonzero(np.cumsum(mark)[:-1]).tolist(), items


def spans(text: str | None, hit: list[int]) -> list[list[int]]:
    """[start, end) code-point offsets in the original text of runs of hit words."""
    if not hit:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    mapped = np.frombuffer(raw.translate(_WORDS), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mapped.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    # bytes that start a code point, counted up to each offset
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    hit_at = np.asarray(hit)
    cut = np.flatnonzero(np.diff(hit_at) > 1)
    first, final = hit_at[np.concatenate(([0], cut + 1))], hit_at[np.concatenate((cut, [len(hit_at) - 1]))]
    return np.stack([points[starts[first]], points[ends[final]]], 1).tolist()


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Per row of ``docs``: (id, text, n_words, hit, items, spans).

    hit: indices of hit words; items: ids, as strings, of items with occurring
    windows; spans: [start, end) offsets of the hit runs in the original text.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // max_bytes) or 1
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if blocks == 1:
        return _pass_over(source, items, width)
    # a row's hits don't depend on its id, but rows are told apart by both, as a text may be most rows' one
    row = [doc_key(F.col("id")).alias("doc"), row_key(F.col("text")).alias("row")]
    parts = [stored(_pass_over(source, items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k), width).where(F.size("hit") > 0)
                    .select(*row, "hit", "items").distinct(), "benchmark-hits") for k in range(blocks)]
    found = reduce(DataFrame.unionAll, parts).groupBy("doc", "row") \
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hit"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    counted = _pass_over(source, items.limit(0), width).drop("hit", "items").select("*", *row)
    return counted.join(found, ["doc", "row"], "left") \
        .select("id", "text", "n_words", *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("hit", "array<int>"), ("items", "array<string>"))])


def _pass_over(source: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(id, text, n_words, hit, items) of each row, by one automaton of all ``items``."""
    shared = _Shared(source.sparkSession, [tuple(r) for r in items.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = _cached(shared, width)
        for batch in batches:
            found = [scan(text, built) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([n for n, _, _ in found], pa.int64()), pa.array([hit for _, hit, _ in found], pa.list_(pa.int32())),
                 pa.array([sorted(ids) for _, _, ids in found], pa.list_(pa.string()))], names=["id", "text", "n_words", "hit", "items"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, text string, n_words long, hit array<int>, items array<string>")


def with_spans(found: DataFrame) -> DataFrame:
    """Adds the hit runs as [start, end) code-point offsets of the original text."""
    offsets = F.udf(spans, "array<array<int>>")
    return found.withColumn("spans", F.when(F.size("hit") > 0, offsets("text", "hit")).otherwise(F.array().cast("array<array<int>>")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("hit").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("hit") > 0).alias("contaminated"))


SQL = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
found AS (
  SELECT doc_id, d.n, i, item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.win = b.win),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS pos FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
