r"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has a bit set where over half of its shingles' XXH64 have
it.  Two fingerprints link at ``bits`` = 3 or fewer differing bits.

Search.  Of two linked fingerprints, one 32-bit half differs in at most one bit.
Each half is covered by the code that joins the perfect Hamming (31, 26) code
with one free bit: 2^27 anchors, covering radius 1.  A fingerprint is replicated
to every anchor within covering radius plus threshold, 1 + 1 = 2 bits, of either
half (at most 17 a half), and marked at its home anchor, the nearest one.  If
two halves differ in at most one bit, the home of the one is within 2 bits of
the other, so each link meets at a home; homes are compared with all that came
to their anchor, over the full 64 bits.

Only links that span are given on: per anchor a row points at the smallest row it
is connected to, so a dense group of near copies costs one link a row instead of
all pairs.  Copies fall together before the search: one row per fingerprint.
An anchor to which more than ``chunk`` rows came is dealt into blocks of homes
times blocks of rows, each compared in a task of its own.

Defined results: a null or empty text has the fingerprint zero and is linked
like any other; rows of one id are all returned, each with its own fingerprint, and
connect through their id; rows with a null id are documents of their own, and name
no component (one of them alone has a null one); ties cannot occur, as the smallest
id names a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, doc_key, null_id, row_key, stored, table
from .components import components

SHINGLE, BITS, SEED, CHUNK = 3, 3, 42, 2048
_PAIRS = 4 << 20
_HASHES = 1 << 16


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """As a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    norm = b" ".join(words)
    if len(words) <= n:
        starts, ends = [0], [len(norm)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes + 1) - 1
        starts, ends = (stops - sizes)[:len(words) - n + 1].tolist(), stops[n - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), _HASHES):
        hashes = np.array([digest(norm[a:b], SEED) for a, b in zip(starts[k:k + _HASHES], ends[k:k + _HASHES], strict=True)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """(doc, fp), a row for each row of ``docs``; doc by :func:`common.doc_key`."""
    return _printed(docs.select(doc_key(F.col(id_col)).alias("doc"), F.col(text_col).alias("text")), n)


def _printed(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, long columns and text, with fp in the place of text."""
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, n) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(prints, pa.int64())], names=[*names, "fp"])

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "fp"]))


#: position of each bit of a half in the Hamming code, and all pairs of positions by their XOR
_PAIR = {s: [(i, i ^ s) for i in range(1, 32) if i < i ^ s] for s in range(1, 32)}


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) for all anchors within 2 bits of 32-bit numbers."""
    half = half.astype(np.int64)
    syndrome = np.zeros(len(half), np.int64)
    for position in range(1, 32):
        syndrome ^= position * (half >> (position - 1) & 1)
    rows, found, home = [], [], []

    def put(at: np.ndarray, values: np.ndarray, is_home: bool) -> None:
        rows.append(at)
        found.append(values)
        home.append(np.full(len(at), is_home))

    for s in range(32):
        at = np.flatnonzero(syndrome == s)
        nearest = half[at] ^ (1 << (s - 1) if s else 0)
        put(at, nearest, True)
        put(at, nearest ^ (1 << 31), False)
        for i, j in _PAIR.get(s, ()):
            put(at, half[at] ^ (1 << (i - 1)) ^ (1 << (j - 1)), False)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(home)


def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("doc", "fp"))
        for side in (0, 1):
            at, anchor, home = anchors(fp >> 32 * side & 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays([pa.array(anchor | side << 32), pa.array(home), pa.array(doc[at]), pa.array(fp[at])],
                                             names=["anchor", "home", "doc", "fp"])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of 0..n-1 is connected to by the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        on = label[a] != label[b]
        a, b = a[on], b[on]
    return label


def compare(group: np.ndarray, home: np.ndarray, doc: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows sorted by group: homes against all rows of their group."""
    first = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    homes = np.flatnonzero(home)
    width = (first[1:] - first[:-1])[of[homes]]
    homes, width = homes[width > 1], width[width > 1]
    total, k, left, right = np.cumsum(width), 0, [], []
    while k < len(homes):
        to = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + _PAIRS, "right")))
        size = width[k:to]
        a = np.repeat(homes[k:to], size)
        b = np.repeat(first[of[homes[k:to]]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        # unsigned: of a negative number numpy counts the bits of its absolute value
        near = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= bits
        near &= a != b
        left.append(a[near])
        right.append(b[near])
        k = to
    if not left:
        return doc[:0], doc[:0]
    label = roots(len(doc), np.concatenate(left), np.concatenate(right))
    at = np.flatnonzero(label != np.arange(len(doc)))
    return doc[at], doc[label[at]]


def links(classes: DataFrame, bits: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between the documents of ``classes`` (doc, fp), one per fingerprint,
    that connect what the fingerprints within ``bits`` connect."""
    if not 0 <= bits <= 3:
        raise ValueError("the anchors cover distances up to 3 bits")
    dealt = classes.select("doc", "fp").mapInArrow(replicate, "anchor long, home boolean, doc long, fp long")
    hot = dealt.groupBy("anchor").count().where(F.col("count") > chunk) \
        .select("anchor", F.ceil(F.col("count") / chunk).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    # a home goes as a home to its row of blocks, and each row as a plain row to its column
    spread = dealt.join(hot, "anchor", "left").withColumn("n", blocks).withColumn("own", own)
    plain = spread.select("anchor", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("across"), F.col("own").alias("down"),
                          F.when(F.col("n") == 1, F.col("home")).otherwise(False).alias("home"), "doc", "fp")
    as_home = spread.where("home and n > 1").select(
        "anchor", F.col("own").alias("across"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("down"), F.lit(True).alias("home"), "doc", "fp")
    keyed = plain.unionByName(as_home).select(F.xxhash64("anchor", "across", "down").alias("key"), "home", "doc", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("key", "home", "doc", "fp")]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            key = columns[0]
            full = int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest = [x[full:] for x in columns]
            if full:
                a, b = compare(*(x[:full] for x in columns), bits)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        if rest is not None and len(rest[0]):
            a, b = compare(*rest, bits)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").where("a <> b")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc, fp, component): a row for each row of ``docs``; component: the smallest
    document reachable over links of fingerprints."""
    prints = stored(fingerprints(docs, id_col, text_col, n), "fingerprints")
    # rows of one id are one document, whatever their texts; a null id is no id
    known = prints.where(F.col("doc") != NO_ID)
    several = known.groupBy("doc").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("doc", "low")
    same_id = known.join(several, "doc").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    # rows of one fingerprint are always connected, so the fingerprint stands for them in the links
    least = components(links(prints.select(F.col("fp").alias("doc"), "fp").distinct(), bits).unionByName(same_id))
    classes = prints.groupBy("fp").agg(F.min(F.when(F.col("doc") != NO_ID, F.col("doc"))).alias("first")) \
        .join(least.select(F.col("a").alias("fp"), "b"), "fp", "left").select("fp", F.coalesce("b", "fp").alias("root"), "first")
    # the fingerprints that stand alone have their component already
    joined = classes.join(least.select(F.col("b").alias("root")).distinct(), "root", "left_semi")
    named = joined.groupBy("root").agg(F.min("first").alias("least"))
    lead = classes.join(named, "root", "left").select("fp", F.coalesce("least", "first", F.lit(NO_ID)).alias("component"))
    return prints.join(lead, "fp").select("doc", "fp", "component")


def leaders(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc, row): the smallest row of each component that fingerprints alone connect;
    an id connects nothing.  row by :func:`common.row_key`."""
    prints = stored(_printed(docs.select(doc_key(F.col(id_col)).alias("doc"), row_key(F.col(text_col)).alias("row"), F.col(text_col).alias("text")), n),
                    "fingerprints")
    # rows of one fingerprint are always connected, so the fingerprint stands for them in the links
    least = components(links(prints.select(F.col("fp").alias("doc"), "fp").distinct(), bits))
    return prints.groupBy("fp").agg(F.min(F.struct("doc", "row")).alias("first")) \
        .join(least.select(F.col("a").alias("fp"), "b"), "fp", "left") \
        .groupBy(F.coalesce("b", "fp").alias("component")).agg(F.min("first").alias("first")).select("first.doc", "first.row")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(table(spark, sf_dir, "documents")).select(
        null_id(F.col("doc")).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        null_id(F.col("component")).alias("component_id"))
