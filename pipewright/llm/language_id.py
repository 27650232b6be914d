r"""Language identification by a bit-sliced Bloom filter of n-grams.

An n-gram is a letter with its two neighbours, lower-cased, where whatever is not
part of a word counts as one blank: ``the`` has `` th``, ``the``, ``he ``.  A
language's set are the n-grams that make up at least one in ``RARE`` of its
training text.

Bit slices.  The Bloom filters of all languages share their hash functions and lie
across each other: a position holds one bit a language.  So the AND of an n-gram's
``HASHES`` positions is the bitmask of all languages that contain it, whatever their
number, for the price of one filter's look-up.  A text's score for a language is
the count of its bit over the text's n-grams; a filter with the share f of its bits
set answers a strange n-gram with yes at a rate of f^HASHES, so of n n-grams with h
hits ``(h / n - f^HASHES) / (1 - f^HASHES)`` are taken as the language's.  The
largest share is the prediction and its score.

Bounds.  Of one language at most ``RARE`` n-grams can each be one in ``RARE`` of its
text, so the sets, the filter (``POSITIONS`` bits a language) and what the driver
sees of them have a size that the languages' number alone decides; it is checked
(``MOST_LANGUAGES``) before the filter is sent out.

Defined results: a null text or one without a letter is ``und`` with score 0, and so
is every text where nothing was learned; equal shares go to the language with more
training documents, then the earlier in UTF-8; rows with a null text or language are
not learned from; in the query a null id is neither held out nor learned from;
repeated rows count again; an empty table gives an empty table; other columns are
never looked at.

Scale: n-grams are counted in their Arrow batches and exchanged as a row a language
and n-gram of a task; prediction moves nothing.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, stored, table
from .textarrays import mix

RARE, POSITIONS, HASHES, FOLDS = 100_000, 1 << 20, 3, 5
MOST_LANGUAGES = 2048
UNKNOWN = "und"
#: counts a task holds, and bits it unpacks, at a time
_HELD, _BITS = 1 << 20, 1 << 24


@cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: whether it is a letter, and whether it is part of a word (letters and marks)."""
    kind = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
    letter = np.array([k == "L" for k in kind])
    return letter, letter | np.array([k == "M" for k in kind])


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram, its text) of every part of a word, texts ascending; whether each text has a letter."""
    letter, word = _kinds()
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer(("\n" + "".join(t + "\n" for t in low)).encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(low)), np.fromiter(map(len, low), np.int64, len(low)) + 1)
    in_word = word[points]
    some = np.zeros(len(low), bool)
    some[of[letter[points[1:]]]] = True
    kept = in_word.copy()
    kept[1:] |= in_word[:-1]  # of a run of others the first one, as a blank
    kept[0] = True
    points, in_word, of = np.where(in_word, points, 32)[kept].astype(np.int64), in_word[kept], np.concatenate((of[:1], of))[kept]
    at = np.flatnonzero(in_word)  # never the first; the last is a blank as well
    return points[at - 1] << 42 | points[at] << 21 | points[at + 1], of[at], some


def positions(grams: np.ndarray, size: int, hashes: int) -> Iterator[np.ndarray]:
    """The positions of n-grams, one array a hash function; size: a power of two."""
    with np.errstate(over="ignore"):
        first = mix(grams.astype(np.uint64) + np.uint64(1))
        step = mix(first) | np.uint64(1)
        for k in range(hashes):
            yield ((first + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64)


@dataclass
class Filter:
    """``slices``: a row of bytes a position, a bit a language; ``wrong``: a language's rate of false yes."""

    langs: list[str]
    slices: np.ndarray
    wrong: np.ndarray
    hashes: int = HASHES

    @classmethod
    def build(cls, langs: list[str], grams: list[np.ndarray], size: int = POSITIONS, hashes: int = HASHES) -> Filter:
        slices, wrong = np.zeros((size, -(-len(langs) // 8)), np.uint8), np.zeros(len(langs))
        for k, own in enumerate(grams):
            set_ = np.zeros(size, bool)
            for at in positions(own, size, hashes):
                set_[at] = True
            slices[:, k // 8] |= set_.astype(np.uint8) << np.uint8(k % 8)
            wrong[k] = set_.mean() ** hashes
        return cls(langs, slices, wrong, hashes)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Of each n-gram the languages that contain it, a bit a language."""
        found = None
        for at in positions(grams, len(self.slices), self.hashes):
            found = self.slices[at] if found is None else found & self.slices[at]
        return found

    def shares(self, grams: np.ndarray, of: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each text; its share of every language's, corrected for false yes). of: ascending."""
        hits, n = np.zeros((texts, len(self.langs)), np.int64), np.bincount(of, minlength=texts)
        step = max(1, _BITS // (8 * self.slices.shape[1]))
        for start in range(0, len(grams), step):
            here = of[start:start + step]
            bits = np.unpackbits(self.masks(grams[start:start + step]), axis=1, count=len(self.langs), bitorder="little")
            first = np.flatnonzero(np.concatenate(([True], here[1:] != here[:-1])))
            hits[here[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        part = hits / np.maximum(n, 1)[:, None]
        return n, np.clip((part - self.wrong) / (1 - self.wrong), 0, 1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, n-grams) of each text."""
        grams, of, some = ngrams(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.bincount(of, minlength=len(texts))
        n, shares = self.shares(grams, of, len(texts))
        best = shares.argmax(axis=1)
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, some)], np.where(some, shares[np.arange(len(texts)), best], 0.0), n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n, docs) of batches (lang, text); a gram of -1 counts the language's documents."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    rows = 0

    def merged() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            gram, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([c for _, c in parts]), len(gram)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])

    for batch in sliced(batches, "text"):
        grams, of, _ = ngrams(batch.column("text").to_pylist())
        langs = batch.column("lang").dictionary_encode()
        lang_of = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            found = pc.value_counts(pa.array(grams[lang_of[of] == k]))
            gram, n = (np.append(found.field(f).to_numpy(zero_copy_only=False), x) for f, x in ((0, -1), (1, np.count_nonzero(lang_of == k))))
            held.setdefault(lang, []).append((gram.astype(np.int64), n.astype(np.int64)))
            rows += len(gram)
        if rows > _HELD:
            yield from merged()
            held, rows = {}, 0
    yield from merged()


def learn(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", rare: int = RARE) -> Filter:
    """The filter of all languages in ``rows``."""
    labelled = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = stored(labelled.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ngrams")
    totals = counts.groupBy("lang").agg(F.sum(F.when(F.col("gram") >= 0, F.col("n")).otherwise(0)).alias("total"),
                                        F.sum(F.when(F.col("gram") < 0, F.col("n")).otherwise(0)).alias("docs"))
    if totals.count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: their filter has {POSITIONS // 8} bytes each")
    # at most MOST_LANGUAGES rows, and of each at most ``rare`` n-grams
    order = sorted(totals.where("total > 0").collect(), key=lambda r: (-r.docs, r.lang.encode()))
    common = counts.where("gram >= 0").join(totals.select("lang", "total"), "lang") \
        .where(F.col("n") * rare >= F.col("total")).groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect()
    sets = {r.lang: np.array(r.grams, np.int64) for r in common}
    return Filter.build([r.lang for r in order], [sets.get(r.lang, np.zeros(0, np.int64)) for r in order])


def predict(docs: DataFrame, found: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score, n_grams): a row for each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            lang, score, n = sent.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(lang, pa.string()), pa.array(score), pa.array(n.astype(np.int64))],
                                             names=["id", "lang", "score", "n_grams"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, lang string, score double, n_grams long")


def fold(doc_id: Column) -> Column:
    """0 for documents that are held out; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs.where(fold(F.col("doc_id")) != 0))).select(
        F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id")) == 0, F.lit(False)).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "n_grams")
