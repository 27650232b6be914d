r"""Byte-level BPE encoding and decoding by a public rank file.

Each text is cut by the split pattern; every distinct word of a batch is encoded
once, by folding ranked merges over its bytes with the rank map, and the ids are
dealt back to where the words stand.  Decoding concatenates the vocabulary's
binary pieces.

The fold as Spark higher-order functions over a literal rank map gave the same
ids, but took 190 microseconds of CPU a distinct word, over 500 CPU seconds for
the 3 million distinct words of half a GB (limit: 437 for everything), so the
fold runs in Arrow batches; see the README.

Defined results: a null or empty text has no ids and decodes to no bytes; rows
that repeat are encoded each for itself; a word of any length is encoded whole
(longer ones with a heap, in n log n steps); an empty table gives an empty one.

Scale: no shuffle and nothing sent to the driver; the tasks get the rank file
(bounded by the vocabulary).  A task holds one run of rows of about
``SLICE`` bytes, and a word memory that is emptied at ``MEMORY`` words.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table

FILE = "byte_bpe_multi_50k.tiktoken"
SLICE, MEMORY, HEAP_FROM = 1 << 20, 400_000, 48
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def vocabulary_path(name: str = FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks have to run from 0 without gaps")
    return [found[i] for i in range(len(found))]


@functools.cache
def _classes() -> np.ndarray:
    """For each code point: white space, letter, number or other, as the split pattern sees it."""
    every = "".join(map(chr, range(0xD800))) + "" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    found = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_SPACE, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            found[m.start():m.end()] = kind
    return found


def starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the matches of the split pattern start.

    points: code points of texts one behind the other; first: True at the start
    of a text.  The pattern: contractions after an apostrophe; runs of letters,
    of numbers or of others, each with one space before it; of a run of white
    space before something else all but the last character, then that one unless
    it is a space, which leads the next match.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = _classes()[points]
    space = kind == _SPACE
    last = np.append(first[1:], True)
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    led = np.zeros(n, bool)  # the character before is a space of the same text
    led[1:] = (points[:-1] == 32) & ~first[1:]
    before_word = np.zeros(n, bool)
    before_word[:-1] = ~space[1:]
    found = np.where(space, run | before_word & ~last, run & ~led)
    for at in np.flatnonzero((points == 39) & found):
        if last[at]:
            continue
        after = chr(points[at + 1])
        size = 2 if after in "stmd" else 0
        if after in "rvl" and not last[at + 1] and after + chr(points[at + 2]) in ("re", "ve", "ll"):
            size = 3
        if size:
            found[at + 1:at + size] = False
            if not last[at + size - 1]:
                found[at + size] = True
    return found


def _fold_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i:i + 2], 1 << 30) for i in range(len(word) - 1)]
    while pairs:
        low = min(pairs)
        if low == 1 << 30:
            break
        i = pairs.index(low)
        merged = parts[i] + parts[i + 1]
        parts[i:i + 2] = [merged]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + merged, 1 << 30)
        if i < len(pairs):
            pairs[i] = ranks.get(merged + parts[i + 1], 1 << 30)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges, the lowest rank and then the leftmost first, from a heap."""
    size = len(word)
    end, prev = list(range(1, size + 1)), list(range(-1, size - 1))  # the part at i ends at end[i]; the part before it
    live = [True] * size
    heap = [(ranks[word[i:i + 2]], i, i + 2) for i in range(size - 1) if word[i:i + 2] in ranks]
    heapq.heapify(heap)

    def offer(left: int) -> None:
        if left >= 0 and end[left] < size:
            to = end[end[left]]
            rank = ranks.get(word[left:to])
            if rank is not None:
                heapq.heappush(heap, (rank, left, to))

    while heap:
        _, i, to = heapq.heappop(heap)
        if not live[i] or end[i] >= size or end[end[i]] != to:
            continue  # one of the two has been merged since
        live[end[i]] = False
        end[i] = to
        if to < size:
            prev[to] = i
        offer(i)
        offer(prev[i])
    return [ranks[word[i:end[i]]] for i in range(size) if live[i]]


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return (_fold_short if len(word) <= HEAP_FROM else _fold_long)(word, ranks)


class Codec:
    """Encodes and decodes runs of texts, remembering words."""

    def __init__(self, tokens: list[bytes]):
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.pieces = pa.array(tokens, pa.large_binary())
        self.seen: dict[bytes, list[int]] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin and, at last, end)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, at, data = texts.buffers()
        at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8)
        at = at - at[0]
        head = np.flatnonzero((raw & 0xC0) != 0x80)  # bytes that begin a code point
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        first = np.zeros(len(raw) + 1, bool)
        first[at] = True
        cuts = np.append(head[starts(points, first[head])], len(raw))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)])
        coded = words.dictionary_encode()
        lists = self._lists(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(sizes.sum()))
        size = sizes[code]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[code] - (stop - size), size) + np.arange(total)]
        return ids, np.concatenate(([0], stop))[np.searchsorted(cuts[:-1], at)]

    def _lists(self, words: list[bytes]) -> list[list[int]]:
        seen, ranks = self.seen, self.ranks
        if len(seen) > MEMORY:
            seen.clear()
        for word in words:
            if word not in seen:
                seen[word] = fold(word, ranks)
        return [seen[w] for w in words]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The concatenated pieces of each text."""
        taken = self.pieces.take(pa.array(ids))
        _, stops, data = taken.buffers()
        edge = np.frombuffer(stops, np.int64)[:len(ids) + 1][at].tolist() if len(ids) else [0] * len(at)
        raw = data.to_pybytes() if data else b""
        return [raw[a:b] for a, b in zip(edge, edge[1:])]


_CODECS: dict[int, Codec] = {}


def _codec(tokens) -> Codec:
    """One codec a worker process, kept from task to task."""
    key = hash(tuple(tokens.value))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tokens.value)
    return _CODECS[key]


def shared_tokens(spark: SparkSession, path: str | None = None):
    return spark.sparkContext.broadcast(read_ranks(path or vocabulary_path()))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids): the ids of each text."""
    tokens = shared_tokens(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokens)
        for batch in sliced(batches, "text", SLICE):
            ids, at = codec.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))], names=["id", "ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> Column:
    """A column with the binary text of the ids in a column of ``encoded``."""
    tokens = shared_tokens(encoded.sparkSession, path)

    @F.pandas_udf("binary")
    def joined(lists: pd.Series) -> pd.Series:
        sizes = [0 if x is None else len(x) for x in lists]
        flat = np.concatenate([np.asarray(x, np.int32) for x in lists if x is not None and len(x)] or [np.zeros(0, np.int32)])
        return pd.Series(_codec(tokens).decode(flat, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)))

    return joined(F.col(ids))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes, then decodes the ids."""
    tokens = shared_tokens(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, digits = _codec(tokens), pa.array([str(i) for i in range(len(tokens.value))])
        for batch in sliced(batches, "text", SLICE):
            ids, at = codec.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), digits.take(pa.array(ids)))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(np.diff(at), pa.int64()),
                pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in pc.binary_join(lists, ",")]),
                pa.array([hashlib.sha256(x).hexdigest() for x in codec.decode(ids, at)])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
