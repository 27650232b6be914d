r"""Divergence of sources: how far a source's words are from its language's and from other sources'.

A term is a run of letters (A-Z lower-cased, all non-ASCII as it is).  A language
keeps the terms of at least ``MIN_DOCS`` of its documents.  Every group (language,
source) and every language gives each of its V kept terms a smoothed share in
whole billionths, ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``, N the kept
terms' occurrences there.  Two parts come out:

* ``pair``: for each group and other source of its language the sum of |p - p'|;
* ``term``: for each group its ``TOP`` terms with the largest p - q > 0, q the language's.

Dominance skyband.  p grows with the count in the group and q with the count in
the language, so a term that another one beats in group count (not less), in
language count (not more) and in UTF-8 order (earlier) never ranks before it.
Every task keeps, a group, the terms that fewer than ``TOP`` others dominate;
the best ``TOP`` of a group are in the union of these skybands, which is then
ranked exactly.  Of a term's dominators only kept ones need be counted, as what
dominates a dropped one dominates it too.

Pairs.  A group's share of a term that it lacks is one constant z.  So a pair's sum
is V |z - z'| plus, over the terms that either has, |p - p'| - |z - z'|.  Groups are
dealt into blocks of about ``BLOCK`` sources, the terms of two blocks into parts of
about ``_ROWS`` rows, and a part compares its blocks' shares as a matrix: what it
puts out is a row a pair of sources, the result's own size, not a row a pair and
term.

Defined results: a null text, language or source is read as the empty one; a
document is a row, so repeated rows count again; a group without terms has N = 0;
a language without kept terms gives its pairs the value 0; equal values rank by
UTF-8; an empty table gives an empty table; other columns are never looked at.

Scale: words are counted over some MB of text at a time, so what is exchanged is a
row a group and term of each such run.  Sums by (language, source, term)
come before those by (language, term): a term of every document meets as one row a
source.  All sums are integers, products are DECIMAL(38,0): nothing is rounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, sliced, stored, table
from .textarrays import raw

MIN_DOCS, TOP, SMOOTH, SCALE, BLOCK = 30, 50, 5, 1_000_000_000, 256
#: bytes of text whose words are counted at a time; rows compared at a time; cells of a matrix; rows of a part
_BYTES, _HELD, _CELLS, _ROWS = 8 << 20, 400_000, 1 << 21, 1 << 17

#: per byte: what is left of it, a blank where it's not part of a term
_TERM = np.full(256, 32, np.uint8)
_TERM[65:91] = np.arange(97, 123)
_TERM[97:123] = np.arange(97, 123)
_TERM[128:] = np.arange(128, 256)

_COUNTS = pa.schema([("lang", pa.large_string()), ("source", pa.large_string()), ("term", pa.large_string()), ("n", pa.int64()), ("docs", pa.int64())])


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """The occurrences n and documents of each (lang, source, term) of a batch (lang, source, text).

    A row with the empty term stands for the group itself.
    """
    data, at = raw(batch.column("text"))
    texts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(_TERM[data]))
    split = pc.ascii_split_whitespace(texts)
    words = pc.list_flatten(split).dictionary_encode()
    doc, code, size = pc.list_parent_indices(split).to_numpy(), words.indices.to_numpy().astype(np.int64), max(len(words.dictionary), 1)
    langs, sources = (batch.column(c).cast(pa.large_string()).dictionary_encode() for c in ("lang", "source"))
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    pairs, n = np.unique(doc.astype(np.int64) * size + code, return_counts=True)
    keys, inverse, docs = np.unique(group[pairs // size] * size + pairs % size, return_inverse=True, return_counts=True)
    n = np.bincount(inverse, n, len(keys)).astype(np.int64)
    # ends of a text may give empty words; their rows become those of the groups
    some = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[keys % size] if len(keys) else np.zeros(0, bool)
    keys, n, docs, every = keys[some], n[some], docs[some], np.unique(group)
    of = np.concatenate((keys // size, every))
    terms = pa.concat_arrays([words.dictionary.take(keys % size).cast(pa.large_string()), pa.array([""] * len(every), pa.large_string())])
    none = np.zeros(len(every), np.int64)
    return pa.Table.from_arrays([langs.dictionary.take(of // len(sources.dictionary)), sources.dictionary.take(of % len(sources.dictionary)), terms,
                                 pa.array(np.concatenate((n, none))), pa.array(np.concatenate((docs, none)))], schema=_COUNTS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in sliced(batches, "text", _BYTES):
        held.append(batch)
        size += batch.nbytes
        if size >= _BYTES:
            yield from term_counts(pa.concat_batches(held)).to_batches(max_chunksize=1 << 16)
            held, size = [], 0
    if held:
        yield from term_counts(pa.concat_batches(held)).to_batches(max_chunksize=1 << 16)


def share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 V)), exactly; null without terms."""
    whole = "decimal(38,0)"
    over = (count.cast(whole) + F.lit(SMOOTH)) * F.lit(SCALE).cast(whole)
    under = total.cast(whole) + F.lit(SMOOTH) * v
    # integral division: neither operand is rounded
    return F.when(v > 0, F.lit(1) + F.call_function("div", over.cast(whole), under.cast(whole)))


def counted(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, first): counts of the kept terms, with the empty term for each group.

    ``first`` marks one row of each (lang, term).
    """
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    per_group = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    return per_group.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"),
        (F.min("source").over(of_term) == F.col("source")).alias("first")) \
        .where((F.col("term") == "") | (F.col("lang_docs") >= min_docs)).drop("lang_docs")


def group_totals(kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row a group: N of the group and of its language, V, the share z of a term it lacks, its block
    of b, and into how many parts the terms of two blocks are dealt."""
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.count_if(F.col("first") & (F.col("term") != "")).alias("firsts"),
                                                F.count(F.lit(1)).alias("rows"))
    of_lang = groups.groupBy("lang").agg(F.sum("group_total").alias("lang_total"), F.sum("firsts").alias("v"),
                                         F.ceil(F.count(F.lit(1)) / block).cast("int").alias("b"), F.sum("rows").alias("rows"))
    # two blocks have 2 / b of the language's rows between them
    return groups.drop("firsts", "rows").join(of_lang, "lang") \
        .withColumn("parts", F.ceil(2 * F.col("rows") / F.col("b") / _ROWS)).drop("rows") \
        .withColumn("z", share(F.lit(0), F.col("group_total"), F.col("v"))) \
        .withColumn("block", F.pmod(F.xxhash64("source"), F.col("b")).cast("int"))


# ---------------------------------------------------------------------------- terms
def skyband(count: np.ndarray, lang_count: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Indices of the points that fewer than k others dominate; term: places in UTF-8 order, all different."""
    order = np.lexsort((term, lang_count, -count))  # a point comes after all that dominate it
    low, early = np.unique(lang_count, return_inverse=True)[1].astype(np.int32), term.astype(np.int32)
    kept = order[:0]
    for start in range(0, len(order), 512):
        new = order[start:start + 512]
        # all that come before have its count or more; in a block those that are dropped from it dominate as well
        over = ((low[kept][:, None] <= low[new]) & (early[kept][:, None] < early[new])).sum(0)
        over += np.triu((low[new][:, None] <= low[new]) & (early[new][:, None] < early[new])).sum(0)
        kept = np.concatenate((kept, new[over < k]))
    return kept


def _skybands(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh = [], 0
        for batch in batches:
            held.append(batch)
            fresh += batch.num_rows
            if fresh > _HELD:
                held, fresh = reduce_groups(pa.Table.from_batches(held), k).to_batches(), 0
        if held:
            yield from reduce_groups(pa.Table.from_batches(held), k).to_batches()

    return run


def reduce_groups(rows: pa.Table, k: int) -> pa.Table:
    """``rows`` (lang, source, term, n, lang_n) without what is outside its group's skyband."""
    rows = rows.combine_chunks()
    place = np.empty(rows.num_rows, np.int64)
    place[pc.sort_indices(rows, [("term", "ascending")]).to_numpy()] = np.arange(rows.num_rows)
    order = pc.sort_indices(rows, [("lang", "ascending"), ("source", "ascending")]).to_numpy()
    n, lang_n = (rows.column(c).to_numpy() for c in ("n", "lang_n"))
    names = rows.select(["lang", "source"]).take(pa.array(order))
    lang, source = (names.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    lang, source = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (lang, source))
    new = np.flatnonzero(np.diff(lang.indices.to_numpy()).astype(bool) | np.diff(source.indices.to_numpy()).astype(bool)) + 1
    keep = [part[skyband(n[part], lang_n[part], place[part], k)] for part in np.split(order, new) if len(part)]
    return rows.take(pa.array(np.concatenate(keep))) if keep else rows


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms whose share in the group is most above the language's."""
    schema = "lang string, source string, term string, n long, lang_n long"
    band = kept.where("term <> '' AND n > 0").select("lang", "source", "term", "n", "lang_n").mapInArrow(_skybands(top), schema)
    v = F.col("v")
    over = band.join(groups, ["lang", "source"]) \
        .select("lang", "source", F.col("term").alias("item"),
                (share(F.col("n"), F.col("group_total"), v) - share(F.col("lang_n"), F.col("lang_total"), v)).alias("value")) \
        .where("value > 0")
    return ranked(over).where(F.col("rank") <= top)


# ---------------------------------------------------------------------------- pairs
def matrix_rows(rest: np.ndarray, is_low: np.ndarray, who: np.ndarray, term: np.ndarray, p: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, sum over the terms of |p - p'| - |z - z'|) for the sources of two blocks.

    ``rest``: the sources' shares z of a term they lack; ``is_low``: whether they are
    of the low block.  A row has a source's place, a term (any numbers) and the share.
    ``same``: one block, each pair once.
    """
    size = len(rest)
    first, second = np.flatnonzero(is_low), np.arange(size) if same else np.flatnonzero(~is_low)
    _, row = np.unique(term, return_inverse=True)
    total, order = np.zeros((len(first), len(second)), np.int64), np.argsort(row, kind="stable")
    row, who, p = row[order], who[order], p[order]
    step = max(1, _CELLS // max(size, 1))
    for start in range(0, int(row[-1]) + 1 if len(row) else 0, step):
        here = slice(*np.searchsorted(row, (start, start + step)))
        cells = np.tile(rest, (int(row[here][-1]) - start + 1, 1))
        cells[row[here] - start, who[here]] = p[here]
        for k, a in enumerate(first):
            total[k] += np.abs(cells[:, second] - cells[:, [a]]).sum(0) - len(cells) * np.abs(rest[second] - rest[a])
    k, j = np.nonzero(total)
    a, b = first[k], second[j]
    once = a < b if same else np.ones(len(a), bool)
    return a[once], b[once], total[k, j][once]


_RUN = ("lang", "lo", "hi", "part")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (lang, lo, hi, part, block, source, term, p, z) sorted by the first four and term.

    Every run of the first four begins with the rows of its two blocks' sources, whose term is empty.
    """
    def out(key: list, sources: pa.Table, rows: pa.Table) -> pa.RecordBatch:
        names, rows = sources.column("source").combine_chunks(), rows.combine_chunks()
        who = pc.index_in(rows.column("source"), names).combine_chunks().to_numpy().astype(np.int64)
        term = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        a, b, value = matrix_rows(sources.column("z").to_numpy(), sources.column("block").to_numpy() == key[1], who, term, rows.column("p").to_numpy(), key[1] == key[2])
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value)],
                                          names=["lang", "a", "b", "value"])

    key, sources, held = None, None, []
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        while rows.num_rows:
            now = [rows.column(c)[0].as_py() for c in _RUN]
            if now != key:
                if held:
                    yield out(key, sources, pa.concat_tables(held))
                key, sources, held = now, rows.slice(0, 0), []
            same = np.logical_and.reduce([pc.equal(rows.column(c), v).to_numpy() for c, v in zip(_RUN, key, strict=True)])
            cut = rows.num_rows if same.all() else int(np.argmin(same))
            part, rows = rows.slice(0, cut), rows.slice(cut)
            of_source = pc.equal(part.column("term"), "")
            sources = pa.concat_tables([sources, part.filter(of_source)])
            part = part.filter(pc.invert(of_source))
            held += [part] if part.num_rows else []
            if sum(t.num_rows for t in held) >= _HELD:  # all but the last term, which may go on
                one = pa.concat_tables(held).combine_chunks()
                cut = int(np.argmax(pc.equal(one.column("term"), one.column("term")[-1]).to_numpy()))
                if cut:
                    yield out(key, sources, one.slice(0, cut))
                held = [one.slice(cut)]
    if held:
        yield out(key, sources, pa.concat_tables(held))


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the group's language by its distance."""
    blocks = F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("other")
    to = [F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]
    # what a pair of sources has without any term: V |z - z'|
    dealt = groups.select("lang", "source", "block", "z", "v", blocks).select("*", *to)
    left, right = (dealt.where(F.col("block") == F.col(c)).select("lang", "lo", "hi", F.col("source").alias(n), F.col("z").alias(f"z_{n}"), *more)
                   for c, n, more in (("lo", "a", ["v"]), ("hi", "b", [])))
    base = left.join(right, ["lang", "lo", "hi"]).where("lo < hi OR a < b") \
        .select("lang", "a", "b", F.coalesce(F.col("v") * F.abs(F.col("z_a") - F.col("z_b")), F.lit(0)).alias("value"))
    # the terms of two blocks are dealt into parts, to each of which the blocks' sources come as well
    there = kept.where("term <> '' AND n > 0").join(groups, ["lang", "source"]) \
        .select("lang", "block", "source", "term", share(F.col("n"), F.col("group_total"), F.col("v")).alias("p"), "z", "parts", blocks) \
        .select("lang", *to, F.pmod(F.xxhash64("term"), "parts").alias("part"), "block", "source", "term", "p", "z")
    sources = groups.select("lang", "block", "source", F.lit("").alias("term"), F.col("z").alias("p"), "z", "parts", blocks) \
        .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")) \
        .select("lang", *to, "part", "block", "source", "term", "p", "z").where("z IS NOT NULL")
    n = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = there.unionByName(sources).repartition(n, *_RUN).sortWithinPartitions(*_RUN, "term") \
        .mapInArrow(_matrices, "lang string, a string, b string, value long")
    once = base.unionByName(more).groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return ranked(once.select("lang", both.alias("_"), "value").select("lang", "_.source", "_.item", "value"))


def ranked(rows: DataFrame) -> DataFrame:
    """With the rank in its group: value descending, item ascending."""
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.select("lang", "source", "item", F.col("value").cast("long").alias("value"), F.row_number().over(place).alias("rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``."""
    kept = stored(counted(docs, min_docs), "term-counts")
    groups = stored(group_totals(kept, block), "groups")
    parts = (source_pairs(kept, groups).withColumn("part", F.lit("pair")), top_terms(kept, groups, top).withColumn("part", F.lit("term")))
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t
  FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM words GROUP BY lang, source, term),
kept AS (
  SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY lang, term HAVING sum(docs) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n, l.v, l.lang_total,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS group_total
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
shares AS (
  SELECT lang, source, term, n,
         1 + ({SCALE}::HUGEINT * (n + {SMOOTH})::HUGEINT) // (group_total + {SMOOTH} * v)::HUGEINT AS p,
         1 + ({SCALE}::HUGEINT * (lang_n + {SMOOTH})::HUGEINT) // (lang_total + {SMOOTH} * v)::HUGEINT AS q
  FROM cells),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= {TOP}
"""
