r"""Removal of repeated byte strings with an enhanced suffix array.

Every ``length`` = 50-byte string (window) that also starts in a document with a
smaller id is found, and the bytes it covers are removed.

1. Documents are dealt into blocks.  In a block each window picks an anchor, the
   start of the ``GRAM``-byte string with the least hash in it.  Equal windows
   pick equal anchors, so equal windows meet where equal anchors meet.
2. The distinct anchor hashes of a block are dealt by hash; those of two blocks,
   or of two documents in a block, come back to their blocks.  An anchor of more
   than ``HOT`` segments (the text around it differs from document to document)
   comes back as hot: its windows are dealt by hashes of their own, and those that
   repeat come back in its place.
3. For these anchors a block gives on the distinct segments (the windows of one
   anchor, up to ``2 * length`` bytes), each with its smallest document; for hot
   anchors each repeated window is a segment.
4. Segments that share anchors are sorted as suffixes.  With the common prefixes
   of neighbours, a stack scan gives the tree of common-prefix intervals; those
   whose occurrences have different bytes before them are the maximal repeats,
   with all their occurrences.  An occurrence is a repeat up to the depth of the
   deepest interval that holds a smaller document.
5. The spans go back to the blocks, where they are removed.

Defined results: null is an empty text; texts under ``length`` bytes lose
nothing; a null id counts as the smallest id; rows of one id are one document,
so they don't take bytes from each other; all rows come back, repeated ones too.

Scale: the texts are exchanged once, by block, and the three passes over them
read that one exchange; beside them anchor hashes (about 8 bytes for each 15 of
text) and segments of repeated anchors move.  A passage that every third
document holds is one segment a block, whatever the number of its documents, and
the windows that reach out of it into each document's own text are spread over all
parts: no task gets more than ``HOT`` segments of an anchor, or a window's row a block.
Numbers of blocks and parts follow the size of the input; nothing is collected.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_key, null_id, table
from .textarrays import Texts, raw

LENGTH, GRAM = 50, 20
BLOCK, PART = 2 << 20, 8 << 20
HOT = 1 << 16  # segments of one anchor that a task compares, some 5 MB
_HASHED = 1 << 20  # bytes of segments hashed at a time
_CHUNK = 1 << 14  # positions whose anchors are sought at a time
_EDGE = 256  # stands for the byte before a segment


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as one number."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))


def _mixed(value: np.ndarray, more: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return value + more


def _strings(words: np.ndarray, at: slice | np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` (8 or more) bytes from positions on: a range or some of them."""
    def word(k: int) -> np.ndarray:
        return words[at.start + k:at.stop + k] if isinstance(at, slice) else words[at + k]

    value = word(0)
    for k in [*range(8, size - 8, 8), size - 8]:
        value = _mixed(value, word(k))
    value = _mixed(value, np.uint64(size))
    value = _mixed(value ^ (value >> np.uint64(32)), np.uint64(0))
    return value ^ (value >> np.uint64(29))


def _ranges(words: np.ndarray, first: np.ndarray, end: np.ndarray, most: int) -> np.ndarray:
    """Hashes of the bytes [first, end), 8 to ``most`` each."""
    value = (end - first).astype(np.uint64)
    for k in range(0, most, 8):
        value = np.where(first + k < end, _mixed(value, words[np.minimum(first + k, end - 8)]), value)
    value = _mixed(value, np.uint64(0))
    return value ^ (value >> np.uint64(32))


class Anchored:
    """The anchors of a run of texts, each with the windows that picked it.

    Positions are hashed and compared some thousands at a time, so that what a
    pass reads is in the processor's cache.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int, gram: int):
        self.data, self.at, self.doc, self.length = data, at, doc, length
        empty = np.zeros(0, np.int64)
        self.key, self.first, self.last, self.text, self.hash = empty.astype(np.uint64), empty, empty, empty, empty.astype(np.uint64)
        n, width = len(data) - length + 1, length - gram + 1
        if n <= 0:
            return
        words, picked = _words(data), np.empty(n, np.int32)
        # a position's value: leading bits of its hash, then its place in the chunk, so the first of equal ones wins
        places = (_CHUNK + width).bit_length()
        place = np.arange(_CHUNK + width, dtype=np.uint32)
        for a in range(0, n, _CHUNK):
            b = min(a + _CHUNK, n)
            hashes = _strings(words[a:b + length - 8].copy(), slice(0, b - a + width - 1), gram)
            least = (hashes >> np.uint64(32 + places)).astype(np.uint32) << np.uint32(places) | place[:len(hashes)]
            span = 1
            while span < width:  # minimum over width grams, by doubling
                step = min(span, width - span)
                least = np.minimum(least[:-step], least[step:])
                span += step
            picked[a:b] = (least & np.uint32((1 << places) - 1)).astype(np.int32) + np.int32(a)
        # windows end within their text: after each text there is a gap
        inside = np.ones(n, bool)
        for stop in at[1:].tolist():
            inside[max(stop - length + 1, 0):stop] = False
        other = picked[1:] != picked[:-1]
        head, tail = inside.copy(), inside.copy()
        head[1:] &= other | ~inside[:-1]
        tail[:-1] &= other | ~inside[1:]
        self.first, self.last = np.flatnonzero(head), np.flatnonzero(tail)
        if not len(self.first):
            return
        key = _strings(words, picked[self.first].astype(np.int64), gram)
        # halves swapped: the leading one is small in anchors, parts are dealt by the other
        self.key, self.text = key << np.uint64(32) | key >> np.uint64(32), np.searchsorted(at, self.first, "right") - 1
        self.hash = _ranges(words, self.first, self.end, length + width - 1) ^ self.key

    @property
    def end(self) -> np.ndarray:
        return self.last + self.length

    def owner(self) -> np.ndarray:
        return self.doc[self.text]

    def cut(self, hot: np.ndarray, others: bool = True) -> Anchored:
        """With the segments of hot anchors cut into windows, each an anchor of its own; ``others``: and the others whole."""
        if not len(self.first):
            return self
        single = np.isin(self.key, hot)
        count = np.where(single, self.last - self.first + 1, int(others))
        of = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        single, key, self.hash, self.text = single[of], self.key[of], self.hash[of], self.text[of]
        self.first, last = self.first[of] + step, self.last[of]
        self.last = np.where(single, self.first, last)
        if single.any():
            self.hash[single] = _ranges(_words(self.data), self.first[single], self.end[single], self.length) ^ key[single]
        self.key = np.where(single, self.hash, key)
        return self


def _anchored(rows: pa.Table, length: int, gram: int) -> Anchored:
    data, at = raw(rows.column("text").combine_chunks())
    return Anchored(data, at, rows.column("doc").to_numpy(), length, gram)


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, start of each group of equal values in that order)."""
    order = np.argsort(values, kind="stable")
    if not len(order):
        return order, order
    return order, np.flatnonzero(np.concatenate(([True], np.diff(values[order]) != 0)))


def _blobs(part: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """(parts, for each column the bytes of each part); part: sorted."""
    head = np.flatnonzero(np.concatenate(([True], np.diff(part) != 0))) if len(part) else np.zeros(0, np.int64)
    cut = np.append(head, len(part))
    return part[head], [[c[a:b].tobytes() for a, b in zip(cut, cut[1:])] for c in columns]


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def common_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of data[a:] and data[b:], up to ``most``."""
    size, live = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(live):
        live = live[size[live] < most[live]]
        live = live[data[a[live] + size[live]] == data[b[live] + size[live]]]
        size[live] += 1
    return size


def intervals(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(depth, first, last) of the common-prefix intervals, children before parents.

    prefix[i]: common prefix of the suffixes i - 1 and i in sorted order, 0 where
    they share too little to count.
    """
    found, stack = [], [(0, 0)]
    for i, size in enumerate([*prefix[1:].tolist(), 0], 1):
        left = i - 1
        while size < stack[-1][0]:
            depth, left = stack.pop()
            found.append((depth, left, i - 1))
        if size > stack[-1][0]:
            stack.append((size, left))
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def window_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows at the positions of segments (one behind the other), some segments at a time."""
    end, place = last + length, np.concatenate(([0], np.cumsum(last - first + 1)))
    out, a = np.empty(len(position), np.uint64), 0
    for b in np.searchsorted(end, np.append(np.arange(_HASHED, len(data), _HASHED), len(data)), "right"):
        if b > a:
            t = Texts(data[first[a]:end[b - 1]], np.array([0, end[b - 1] - first[a]]))
            start = position[place[a]:place[b]] - first[a]
            out[place[a]:place[b]] = t.hashes(start, start + length)
            a = b
    return out


def maximal_repeats(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(position, segment, depth, low, high): suffixes of segments in sorted order,
    and the intervals [low, high] of that order that are maximal repeats of ``length`` or more.

    The suffixes start at first..last of each segment, which ends at last + length.
    Depths end with the shorter segment.  The byte before a segment's first suffix
    counts as different from all.
    """
    count = last - first + 1
    segment = np.repeat(np.arange(len(first)), count)
    position = first[segment] + np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    none = np.zeros(0, np.int64)
    if not len(position):
        return none, none, none, none, none
    # runs of equal windows, by hash; where all have the same byte before them, the repeat starts further left
    window = window_hashes(data, first, last, position, length)
    order = np.argsort(window)
    head = np.flatnonzero(np.concatenate(([True], np.diff(window[order]) != 0)))
    before = np.where(position == first[segment], np.int64(_EDGE), data[np.maximum(position - 1, 0)].astype(np.int64))
    sorted_before, size = before[order], np.diff(np.append(head, len(order)))
    least = np.minimum.reduceat(sorted_before, head)
    open_ = (size > 1) & ((least != np.maximum.reduceat(sorted_before, head)) | (least == _EDGE))
    chosen = order[np.repeat(open_, size)]
    if not len(chosen):
        return none, none, none, none, none
    # the suffix array of what is left: the window's bytes, then those up to the segment's end
    position, segment, before = position[chosen], segment[chosen], before[chosen]
    rest = (last + length)[segment] - position - length
    keys = []
    for k in [*range(0, length - 7, 8), length - 8]:
        word = np.zeros(len(position), np.uint64)
        for i in range(k, k + 8):
            word = word << np.uint64(8) | data[position + i].astype(np.uint64)
        keys.append(word)
    windows = len(keys)
    for k in range(0, int(rest.max()), 7):
        word = np.zeros(len(position), np.uint64)
        for i in range(k, k + 7):
            inside = i < rest
            word = word << np.uint64(9) | np.where(inside, data[np.minimum(position + length + i, len(data) - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0))
        keys.append(word)
    order = np.lexsort(keys[::-1])
    position, segment, before, rest = position[order], segment[order], before[order], rest[order]
    same = np.ones(len(order) - 1, bool)
    for word in keys[:windows]:
        value = word[order]
        same &= value[1:] == value[:-1]
    prefix = np.zeros(len(position), np.int64)
    inner = np.flatnonzero(same) + 1
    prefix[inner] = length + common_prefix(data, position[inner - 1] + length, position[inner] + length, np.minimum(rest[inner - 1], rest[inner]))
    depth, low, high = intervals(prefix)
    if len(depth):
        bounds = np.stack([low, high + 1], 1).ravel()
        padded = np.append(before, before[-1:])
        least, most = (f.reduceat(padded, bounds)[::2] for f in (np.minimum, np.maximum))
        diverse = (least != most) | (least == _EDGE)
        depth, low, high = depth[diverse], low[diverse], high[diverse]
    return position, segment, depth, low, high


def repeated_spans(data: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, offset, size) of what each segment shares with a segment of a smaller document."""
    position, segment, depth, low, high = maximal_repeats(data, first, last, length)
    of = doc[segment]
    best = np.zeros(len(position), np.int64)
    if len(depth):
        least = np.minimum.reduceat(np.append(of, of[-1:]), np.stack([low, high + 1], 1).ravel())[::2]
        size = high - low + 1
        total = np.cumsum(size)
        k = 0
        while k < len(size):  # the occurrences of some intervals at a time
            to = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + (4 << 20), "right")))
            part = size[k:to]
            at = np.repeat(low[k:to], part) + np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
            later = of[at] > np.repeat(least[k:to], part)
            np.maximum.at(best, at[later], np.repeat(depth[k:to], part)[later])
            k = to
    hit = np.flatnonzero(best)
    return segment[hit], position[hit] - first[segment[hit]], best[hit]


def _blocks(docs: DataFrame, id_col: str, text_col: str, block: int) -> tuple[DataFrame, int]:
    source = docs.select(doc_key(F.col(id_col)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = source.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    return source.select(F.pmod(F.xxhash64("doc", "text"), F.lit(math.ceil((size + 1) / block))).alias("block"), "doc", "text"), size


SCHEMA = "doc long, text string, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"


_OUT = pa.schema([("doc", pa.int64()), ("text", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   block: int = BLOCK, part: int = PART, with_text: bool = True, hot: int = HOT) -> DataFrame:
    """A row of :data:`SCHEMA` for each row of ``docs``.

    spans: the removed [start, end) byte ranges, as long as they get; text: the
    text as given (null without ``with_text``); doc by :func:`common.doc_key`.
    hot: segments from which an anchor's windows are dealt singly.
    """
    if not 8 <= gram <= length:
        raise ValueError("gram: from 8 to length")
    rows, size = _blocks(docs, id_col, text_col, block)
    parts = math.ceil((size + 1) / part)

    def dealt(found: Anchored, block_id: int | None) -> pa.Table:
        order, head = _groups(found.key)
        owner = found.owner()[order]
        low, high = (f.reduceat(owner, head) if len(head) else owner for f in (np.minimum, np.maximum))
        key = found.key[order][head]
        # the distinct segments of each key: all first ones of equal hashes
        by_hash, one = _groups(found.hash)
        segments = np.bincount(np.searchsorted(key, found.key[by_hash[one]]), minlength=len(key))
        count = (segments * 2 + (low != high)).astype(np.uint32)
        # keys are sorted, so the parts, their leading bits, are too
        of, (key_blob, count_blob) = _blobs(((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64), key, count)
        return pa.table({"part": pa.array(of, pa.int64()), "block": pa.array([block_id] * len(of), pa.int64()),
                         "keys": pa.array(key_blob, pa.binary()), "counts": pa.array(count_blob, pa.binary())})

    def keys(group: pa.Table) -> pa.Table:
        return dealt(_anchored(group, length, gram), group.column("block")[0].as_py())

    def windows(group: pa.Table, back: pa.Table) -> pa.Table:
        wide = _joined(back.column("hot"), np.uint64)
        if not len(group) or not len(wide):
            return dealt(_anchored(group.slice(0, 0), length, gram), None)
        return dealt(_anchored(group, length, gram).cut(wide, others=False), group.column("block")[0].as_py())

    def repeated(group: pa.Table) -> pa.Table:
        key, counts = _joined(group.column("keys"), np.uint64), _joined(group.column("counts"), np.uint32)
        sizes = np.array([len(x) // 8 for x in group.column("keys").to_pylist()])
        order, head = _groups(key)
        count, many = np.diff(np.append(head, len(key))), np.maximum.reduceat(counts[order] & np.uint32(1), head)
        total = np.add.reduceat((counts[order] >> np.uint32(1)).astype(np.int64), head)
        again, wide = np.zeros(len(key), bool), np.zeros(len(key), bool)
        again[order] = np.repeat((count > 1) | (many > 0), count)
        wide[order] = np.repeat(total > hot, count)
        cut = np.concatenate(([0], np.cumsum(sizes)))
        found = [(b, key[i:j][again[i:j] & ~wide[i:j]].tobytes(), key[i:j][again[i:j] & wide[i:j]].tobytes())
                 for b, i, j in zip(group.column("block").to_pylist(), cut, cut[1:]) if again[i:j].any()]
        return pa.table({"block": pa.array([x[0] for x in found], pa.int64()), "keys": pa.array([x[1] for x in found], pa.binary()),
                         "hot": pa.array([x[2] for x in found], pa.binary())})

    def segments(group: pa.Table, back: pa.Table) -> pa.Table:
        out = {"part": [], "block": [], "hash": [], "size": [], "doc": [], "data": [], "hot": []}
        if len(group) and len(back):
            block_id, wide = group.column("block")[0].as_py(), _joined(back.column("hot"), np.uint64)
            found = _anchored(group, length, gram).cut(wide)
            chosen = np.flatnonzero(np.isin(found.key, _joined(back.column("keys"), np.uint64)))
            order, head = _groups(found.hash[chosen])
            one = chosen[order[head]]
            doc = np.minimum.reduceat(found.owner()[chosen][order], head) if len(head) else found.doc[:0]
            where = ((found.key[one] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(where, kind="stable")
            one, doc, where = one[by], doc[by], where[by]
            first, end = found.first[one], found.end[one]
            of, (hashes, sizes, docs_) = _blobs(where, found.hash[one], (end - first).astype(np.uint16), doc)
            cut = np.append(np.flatnonzero(np.concatenate(([True], np.diff(where) != 0))), len(where)) if len(where) else [0]
            out = {"part": of.tolist(), "block": [block_id] * len(of), "hash": hashes, "size": sizes, "doc": docs_, "hot": [b""] * len(of),
                   "data": [pa.compress(b"".join(found.data[a:b].tobytes() for a, b in zip(first[i:j], end[i:j])), "zstd", asbytes=True)
                            for i, j in zip(cut, cut[1:])]}
            if len(wide):  # goes on to the last pass, which cuts the same segments
                row = {"part": block_id % parts, "block": block_id, "hash": b"", "size": b"", "doc": b"", "hot": wide.tobytes(),
                       "data": pa.compress(b"", "zstd", asbytes=True)}
                out = {k: [*v, row[k]] for k, v in out.items()}
        kinds = {"part": pa.int64(), "block": pa.int64()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()})

    def compare(group: pa.Table) -> pa.Table:
        hashes, sizes, doc = (_joined(group.column(k), t) for k, t in (("hash", np.uint64), ("size", np.uint16), ("doc", np.int64)))
        stop = np.cumsum(sizes.astype(np.int64))
        raw_sizes = [int(np.frombuffer(x, np.uint16).sum(dtype=np.int64)) for x in group.column("size").to_pylist()]
        data = np.frombuffer(b"".join(pa.decompress(x, n, "zstd", asbytes=True) for x, n in zip(group.column("data").to_pylist(), raw_sizes)), np.uint8)
        segment, offset, size = repeated_spans(data, stop - sizes, stop - length, doc, length)
        block_of = np.repeat(group.column("block").to_numpy(), [len(x) // 8 for x in group.column("hash").to_pylist()])[segment]
        by = np.argsort(block_of, kind="stable")
        of, (h, o, s) = _blobs(block_of[by], hashes[segment][by], offset[by].astype(np.uint16), size[by].astype(np.uint16))
        passed = [(b, x) for b, x in zip(group.column("block").to_pylist(), group.column("hot").to_pylist()) if x]
        none = [b""] * len(passed)
        return pa.table({"block": pa.array(of.tolist() + [b for b, _ in passed], pa.int64()), "hash": pa.array(h + none, pa.binary()),
                         "offset": pa.array(o + none, pa.binary()), "size": pa.array(s + none, pa.binary()),
                         "hot": pa.array([b""] * len(of) + [x for _, x in passed], pa.binary())})

    def removed(group: pa.Table, back: pa.Table) -> pa.Table:
        if not len(group):
            return _OUT.empty_table()
        found = _anchored(group, length, gram).cut(_joined(back.column("hot"), np.uint64))
        mark = np.zeros(len(found.data) + 1, np.int64)
        order, head = _groups(found.hash)
        if len(order):
            owner = found.owner()[order]
            low = np.repeat(np.minimum.reduceat(owner, head), np.diff(np.append(head, len(order))))
            # whoever is not the block's first document with a segment repeats all of it
            later = order[owner > low]
            np.add.at(mark, found.first[later], 1)
            np.add.at(mark, found.end[later], -1)
            if len(back):
                first = order[owner == low]  # sorted by hash
                hashes, offset, size = (_joined(back.column(k), t) for k, t in (("hash", np.uint64), ("offset", np.uint16), ("size", np.uint16)))
                own = found.hash[first]
                a, b = np.searchsorted(own, hashes, "left"), np.searchsorted(own, hashes, "right")
                count = b - a
                at = first[np.repeat(a, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
                start = found.first[at] + np.repeat(offset.astype(np.int64), count)
                np.add.at(mark, start, 1)
                np.add.at(mark, start + np.repeat(size.astype(np.int64), count), -1)
        gone = np.cumsum(mark)[:-1] > 0
        return pa.Table.from_arrays(_results(group, found.data, found.at, gone, with_text), schema=_OUT)

    # one exchange of the texts serves all passes over them
    by_block, dealt_schema, back_schema = rows.groupBy("block"), "part long, block long, keys binary, counts binary", "block long, keys binary, hot binary"
    again = by_block.applyInArrow(keys, dealt_schema).groupBy("part").applyInArrow(repeated, back_schema)
    single = by_block.cogroup(again.where("length(hot) > 0").select("block", "hot").groupBy("block")).applyInArrow(windows, dealt_schema).groupBy("part").applyInArrow(repeated, back_schema)
    # a repeated window is compared as such, in however many blocks it is
    back = again.union(single.select("block", F.concat("keys", "hot").alias("keys"), F.lit(b"").alias("hot")))
    spans = by_block.cogroup(back.groupBy("block")) \
        .applyInArrow(segments, "part long, block long, hash binary, size binary, doc binary, data binary, hot binary") \
        .groupBy("part").applyInArrow(compare, "block long, hash binary, offset binary, size binary, hot binary")
    return by_block.cogroup(spans.groupBy("block")).applyInArrow(removed, SCHEMA)


def _results(group: pa.Table, data: np.ndarray, at: np.ndarray, gone: np.ndarray, with_text: bool) -> list[pa.Array]:
    total = np.concatenate(([0], np.cumsum(gone)))
    n_removed = total[at[1:]] - total[at[:-1]]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begin, close = gone.copy(), gone.copy()
    begin[1:] &= ~gone[:-1] | edge[1:-1]
    close[:-1] &= ~gone[1:] | edge[1:-1]
    begin, close = np.flatnonzero(begin), np.flatnonzero(close) + 1
    text = np.searchsorted(at, begin, "right") - 1
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(at))), pa.int32()), pa.StructArray.from_arrays(
        [pa.array(begin - at[text], pa.int64()), pa.array(close - at[text], pa.int64())], ["start", "end"]))
    kept = data[~gone]
    cut = (at - total[at]).tolist()
    digest = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(cut, cut[1:])]
    n = len(at) - 1
    return [group.column("doc").combine_chunks(), group.column("text").combine_chunks().cast(pa.string()) if with_text else pa.nulls(n, pa.string()),
            pa.array(np.diff(at)), pa.array(n_removed), spans, pa.array(digest, pa.string())]


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).select(
        null_id(F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(generate_series(0, CAST(length(h) / 2 AS BIGINT) - 50)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (
  SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM w JOIN f ON w.s = f.s AND w.doc_id > f.least),
r AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g)
  GROUP BY doc_id, k),
k AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before,
         row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS is_last
  FROM r),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || max(CASE WHEN is_last THEN substr(h, 2 * b + 1) ELSE '' END) AS h
  FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(d.h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
