r"""Language-model scoring with causal self-attention over subword ids.

The model of a text is a chain over its tokens (words, A-Z lower-cased, and one
end): p(token | before) = p(subword id | ids before) * p(token | subword id).

* The subword of a word is its last ``SUBWORD`` bytes.  The ``IDS`` - 3 subwords
  with most training tokens have ids; the other subwords share one, the end and
  the start of a text have theirs.
* p(id | ids before): one causal self-attention layer with residual and output
  softmax, trained in numpy.  Windows of ``WINDOW`` ids overlap by ``CONTEXT``;
  each token is scored once, with at least ``CONTEXT`` ids before it where the
  text has them, in batches of masked windows.
* p(token | id) = (c + 0.5) / (N_id + 0.5 * (V_id + 1)), from the counts of all
  training documents; beside it the base model without ids, from the same counts.

Learning.  Counts cover every training document, as one table of word hashes.
The attention weights start from the id counts; in ``ROUNDS`` rounds each task
runs local gradient steps on its part of the training documents of the round, and
the tasks' weights are averaged.  The rounds part the training documents by id
hash, so that together they learn from every one once, at every size; nothing is
gathered in one place.

Defined results: a null or empty text is the end token alone; a null id is read
as the empty text for the learning rule; repeated rows count and are scored each
for itself; without training documents N and V are 0 and all tokens unknown.
Words are told apart by 64-bit hashes.

Scale: one exchange of (hash, count) rows, merged in each task before; the
most frequent words, ``HOT`` at most, go to the tasks as two arrays; the other
words of a document, few and by definition not skewed, meet their counts in a
join that moves (row, hash, times).  Texts are never exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, stored, table
from .textarrays import Texts, lower, raw

SUBWORD, IDS, HOT = 3, 128, 1 << 18
WINDOW, CONTEXT, DIM = 32, 8, 16
ROUNDS, STEP_WINDOWS, RATE = 3, 64, 0.01
OTHER, END, START = IDS - 3, IDS - 2, IDS - 1
_MERGE = 2 << 20
_SCORED = WINDOW - CONTEXT


def words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(hash, subword, text) of every word, and the number of texts."""
    data, at = raw(batch.column("text"))
    t = Texts(lower(data), at)
    start, end, text = t.words()
    subword = np.zeros(len(start), np.int64)
    for k in range(SUBWORD, 0, -1):
        at_k = end - k
        subword = np.where(at_k >= start, subword << 8 | t.data[np.maximum(at_k, 0)], subword)
    return t.hashes(start, end).view(np.int64), subword, text, t.n


# ---- the attention layer -------------------------------------------------------------------------------------------


def initial(frequency: np.ndarray) -> dict[str, np.ndarray]:
    random = np.random.default_rng(11)
    draw = lambda *shape: (random.standard_normal(shape) / np.sqrt(shape[0] if len(shape) > 1 else 1)).astype(np.float32)
    return {"embed": draw(IDS, DIM) * np.float32(np.sqrt(IDS)) * 0.3, "place": draw(WINDOW, DIM) * 0.1, "query": draw(DIM, DIM), "key": draw(DIM, DIM),
            "value": draw(DIM, DIM), "out": draw(DIM, DIM), "logit": draw(DIM, IDS) * 0.3, "bias": np.log(frequency / frequency.sum()).astype(np.float32)}


def windows(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, owner) of all windows; -1 where there is nothing.

    ids: the ids of texts one behind the other, each with its end; at: offsets.
    inputs[w] are the ids before each target, after ``CONTEXT`` earlier ones.
    """
    size = np.diff(at)
    count = -(-size // _SCORED)
    owner = np.repeat(np.arange(len(size)), count)
    begin = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * _SCORED
    place = begin[:, None] + np.arange(-CONTEXT, _SCORED)  # of the target each input stands before
    inside = place < size[owner][:, None]
    source = np.clip(at[owner][:, None] + place - 1, 0, max(len(ids) - 1, 0))
    inputs = np.where(place == 0, START, ids[source])
    inputs[(place < 0) | ~inside] = -1
    targets = np.where(inside[:, CONTEXT:], ids[np.clip(source[:, CONTEXT:] + 1, 0, len(ids) - 1)], -1)
    # the start stands before the first target, so that one is not one behind its source
    first = place[:, CONTEXT:] == 0
    targets[first] = ids[at[owner]][:, None].repeat(_SCORED, 1)[first]
    return inputs, targets, owner


_CAUSAL = np.arange(WINDOW)[None, :] <= np.arange(CONTEXT, WINDOW)[:, None]
_SCALE, _MOST = np.float32(DIM**-0.5), np.float32(60)
_ONES = np.ones((IDS, 1), np.float32)


def _flat(a: np.ndarray) -> np.ndarray:
    return a.reshape(-1, a.shape[-1])


def forward(p: dict, inputs: np.ndarray) -> tuple:
    """Everything up to the logits.  Products over all windows at once, as one matrix.

    Scores and logits are held to +-60 wherever they count, so what they give is a
    distribution and nothing overflows.
    """
    x = p["embed"][np.maximum(inputs, 0)]
    x += p["place"]
    both = (_flat(x) @ np.concatenate((p["query"], p["key"], p["value"]), 1)).reshape(*x.shape[:2], 3 * DIM)
    q, k, v = both[:, CONTEXT:, :DIM], both[:, :, DIM:2 * DIM], both[:, :, 2 * DIM:]
    weight = q @ k.transpose(0, 2, 1)
    weight *= _SCALE
    np.clip(weight, -_MOST, _MOST, out=weight)
    np.exp(weight, out=weight)
    weight *= _CAUSAL & (inputs >= 0)[:, None, :]
    weight /= np.maximum(weight.sum(-1, keepdims=True), np.float32(1e-30))
    mixed = _flat(weight @ v)
    hidden = mixed @ p["out"]
    hidden += _flat(x[:, CONTEXT:])
    logits = hidden @ p["logit"]
    logits += p["bias"]
    np.clip(logits, -_MOST, _MOST, out=logits)
    return x, q, k, v, weight, mixed, hidden, logits.reshape(*q.shape[:2], IDS)


def log_probabilities(p: dict, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithm of each target's probability; 0 where there is none."""
    out = np.zeros(targets.shape, np.float32)
    for k in range(0, len(inputs), STEP_WINDOWS):
        logits, part = _flat(forward(p, inputs[k:k + STEP_WINDOWS])[-1]), targets[k:k + STEP_WINDOWS].ravel()
        chosen = logits[np.arange(len(part)), np.maximum(part, 0)]
        chosen -= np.log((np.exp(logits, out=logits) @ _ONES)[:, 0])
        out[k:k + STEP_WINDOWS] = np.where(part >= 0, chosen, 0).reshape(-1, _SCORED)
    return out


def gradient(p: dict, inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    x, q, k, v, weight, mixed, hidden, logits = forward(p, inputs)
    target, d = targets.ravel(), _flat(logits)
    np.exp(d, out=d)
    some = target >= 0
    # rows without a target weigh nothing
    d *= some[:, None] / (d @ _ONES) / np.float32(max(np.count_nonzero(some), 1))
    rows = np.flatnonzero(some)
    d[rows, target[rows]] -= np.float32(1 / max(len(rows), 1))
    g = {"logit": hidden.T @ d, "bias": d.sum(0)}
    d_hidden = d @ p["logit"].T
    g["out"] = mixed.T @ d_hidden
    d_mixed = (d_hidden @ p["out"].T).reshape(q.shape)
    d_scores = d_mixed @ v.transpose(0, 2, 1)
    d_scores -= np.einsum("wij,wij->wi", d_scores, weight)[..., None]
    d_scores *= weight
    d_scores *= _SCALE
    d_both = np.zeros((*x.shape[:2], 3 * DIM), np.float32)
    d_both[:, CONTEXT:, :DIM] = d_scores @ k
    d_both[:, :, DIM:2 * DIM] = d_scores.transpose(0, 2, 1) @ q
    d_both[:, :, 2 * DIM:] = weight.transpose(0, 2, 1) @ d_mixed
    g |= dict(zip(("query", "key", "value"), np.split(_flat(x).T @ _flat(d_both), 3, axis=1), strict=True))
    d_x = (_flat(d_both) @ np.concatenate((p["query"], p["key"], p["value"]), 1).T).reshape(x.shape)
    d_x[:, CONTEXT:] += d_hidden.reshape(q.shape)
    d_x[inputs < 0] = 0
    g["place"] = d_x.sum(0)
    at = np.maximum(inputs, 0).ravel()
    g["embed"] = np.stack([np.bincount(at, column, IDS) for column in np.ascontiguousarray(_flat(d_x).T)], 1).astype(np.float32)
    return g


def train(p: dict, pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[dict, int]:
    """Local gradient steps (Adam) over the windows of (ids, offsets); and their number."""
    every = np.concatenate([v.ravel() for v in p.values()]).astype(np.float32)
    cut = np.cumsum([v.size for v in p.values()])[:-1]
    p = {k: a.reshape(v.shape) for (k, v), a in zip(p.items(), np.split(every, cut), strict=True)}  # views: one array is stepped
    first, second, step = np.zeros_like(every), np.zeros_like(every), 0
    for ids, at in pieces:
        inputs, targets, _ = windows(ids, at)
        order = np.random.default_rng(len(inputs)).permutation(len(inputs))
        for k in range(0, len(order), STEP_WINDOWS):
            chosen = order[k:k + STEP_WINDOWS]
            step += 1
            found = gradient(p, inputs[chosen], targets[chosen])
            g = np.concatenate([found[name].ravel() for name in p])
            first += np.float32(0.1) * (g - first)
            second += np.float32(0.01) * (g * g - second)
            root = np.sqrt(second / np.float32(1 - 0.99**step))
            root += np.float32(1e-6)
            every -= np.float32(RATE / (1 - 0.9**step)) * first / root
    return p, step


# ---- learning and scoring with Spark -------------------------------------------------------------------------------


class Model:
    """What scoring needs; every part is bounded."""

    def __init__(self, subwords: np.ndarray, of_id: np.ndarray, frequency: np.ndarray, weights: dict, hot: np.ndarray, hot_count: np.ndarray, ends: int):
        self.subwords, self.of_id = subwords, of_id  # sorted subwords with ids, and those ids
        self.frequency, self.weights, self.hot, self.hot_count, self.ends = frequency, weights, hot, hot_count, ends

    def ids(self, subword: np.ndarray) -> np.ndarray:
        if not len(self.subwords):
            return np.full(len(subword), OTHER)
        at = np.minimum(np.searchsorted(self.subwords, subword), len(self.subwords) - 1)
        return np.where(self.subwords[at] == subword, self.of_id[at], OTHER)

    def sequences(self, subword: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of n texts, each with its end, and their offsets."""
        at = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n) + 1)))
        ids = np.full(at[-1], END)
        ids[np.arange(len(subword)) + text] = self.ids(subword)
        return ids, at


def learns(id_col: Column) -> Column:
    """The learning rule of the contract: crc32 of the id's text mod 5 is not 1."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 != 1


def word_counts(texts: DataFrame) -> DataFrame:
    """(hash, subword, n) of all words of the column text."""

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, subword, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        key, at, group = np.unique(hashes, return_index=True, return_inverse=True)
        return key, subword[at], np.bincount(group, n, len(key)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in sliced(batches, "text"):
            hashes, subword, _, _ = words(batch)
            parts.append(merged([(hashes, subword, np.ones(len(hashes), np.int64))]))
            size += len(parts[-1][0])
            if size > _MERGE:
                parts = [merged(parts)]
                size = len(parts[0][0])
                if size > _MERGE // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["hash", "subword", "n"])
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(parts)], names=["hash", "subword", "n"])

    return texts.select("text").mapInArrow(run, "hash long, subword long, n long").groupBy("hash") \
        .agg(F.min("subword").alias("subword"), F.sum("n").alias("n"))


def _hot(counts: DataFrame) -> DataFrame:
    """The most frequent words, ``HOT`` at most: all from a count on, found by counting on its logarithm."""
    level = F.floor(F.log2("n") * 8)
    room, least = HOT, None
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # some hundred levels
        room -= r["count"]
        if room < 0:
            break
        least = r.level
    return counts.where(level >= least) if least is not None else counts.limit(0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame, int, int]:
    """The model, the table of counts (hash, subword, n), and N and V of the base model."""
    spark = docs.sparkSession
    training = docs.where(learns(F.col(id_col))).select(F.xxhash64(F.col(id_col).cast("long")).alias("at"), F.col(text_col).alias("text"))
    counts = stored(word_counts(training), "word-counts")
    ends = training.count()
    total, distinct = (int(x or 0) for x in counts.agg(F.sum("n"), F.count(F.lit(1))).first())
    by_subword = counts.groupBy("subword").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).orderBy(F.desc("n"), "subword").limit(OTHER).collect()
    hot = _hot(counts).select("hash", "n").toPandas().sort_values("hash")
    frequency = np.zeros((IDS, 2))
    for k, r in enumerate(by_subword):
        frequency[k] = r.n, r.v
    frequency[OTHER] = total - frequency[:OTHER, 0].sum(), distinct - frequency[:OTHER, 1].sum()
    frequency[END] = ends, min(ends, 1)
    subwords = np.array([r.subword for r in by_subword], np.int64)
    order = np.argsort(subwords)
    model = Model(subwords[order], order, frequency, initial(frequency[:, 0] + 0.5), hot.hash.to_numpy(np.int64), hot.n.to_numpy(np.int64), ends)
    for k in range(ROUNDS):
        model.weights = _round(spark, training.where(F.pmod("at", F.lit(ROUNDS)) == k), model)
    return model, counts, total + ends, distinct + min(ends, 1)


def _round(spark: SparkSession, part: DataFrame, model: Model) -> dict:
    """One round of local steps in all tasks; the weights averaged by their steps."""
    shared = spark.sparkContext.broadcast(model)
    names = list(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in sliced(batches, "text"):
                _, subword, text, n = words(batch)
                yield shared.value.sequences(subword, text, n)

        weights, steps = train(shared.value.weights, pieces())
        if steps:
            flat = np.concatenate([weights[k].ravel() for k in names]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * steps), pa.array(np.full(len(flat), steps))],
                                             names=["place", "value", "steps"])

    got = part.select("text").mapInArrow(run, "place long, value double, steps long").groupBy("place") \
        .agg((F.sum("value") / F.sum("steps")).alias("value")).toPandas().sort_values("place")
    if not len(got):
        return model.weights
    flat, out, at = got.value.to_numpy(np.float32), {}, 0
    for k in names:
        shape = model.weights[k].shape
        out[k] = flat[at:at + int(np.prod(shape))].reshape(shape)
        at += int(np.prod(shape))
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row."""
    model, counts, n_all, v_all = fit(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        within = np.log10(m.frequency[:, 0] + 0.5 * (m.frequency[:, 1] + 1))
        for batch in sliced(batches, "text", 1 << 20):
            hashes, subword, text, n = words(batch)
            ids, at = m.sequences(subword, text, n)
            inputs, targets, owner = windows(ids, at)
            model_score = np.bincount(owner, log_probabilities(m.weights, inputs, targets).sum(1, dtype=np.float64), n) / np.log(10)
            model_score -= np.add.reduceat(within[ids], at[:-1]) if n else 0
            place = np.minimum(np.searchsorted(m.hot, hashes), max(len(m.hot) - 1, 0))
            known = m.hot[place] == hashes if len(m.hot) else np.zeros(len(hashes), bool)
            value = np.log10(m.hot_count[place[known]] + 0.5)
            n_known = np.bincount(text[known], minlength=n) + (m.ends > 0)
            total = np.bincount(text[known], value, n) + np.log10(m.ends + 0.5)
            # the rest of each text: distinct hashes and how often
            order = np.lexsort((hashes[~known], text[~known]))
            h, of = hashes[~known][order], text[~known][order]
            head = np.flatnonzero(np.concatenate(([True], (np.diff(h) != 0) | (np.diff(of) != 0)))) if len(h) else np.zeros(0, np.int64)
            times = np.diff(np.append(head, len(h)))
            cut = pa.array(np.searchsorted(of[head], np.arange(n + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(at), pa.int64()), pa.array(n_known, pa.int64()), pa.array(total),
                 pa.array(model_score), pa.ListArray.from_arrays(cut, pa.array(h[head])), pa.ListArray.from_arrays(cut, pa.array(times.astype(np.int32)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "counted", "modelled", "rest", "times"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~learns(F.col(id_col))).alias("held_out"), F.col(text_col).alias("text"))
    passed = stored(source.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, counted double, modelled double, "
                                           "rest array<long>, times array<int>").withColumn("at", F.monotonically_increasing_id()), "scored")
    rest = passed.select("at", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("at", F.col("r.rest").alias("hash"), F.col("r.times").alias("times")) \
        .join(counts.select("hash", "n"), "hash", "left") \
        .groupBy("at").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("known"),
                           F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("counted_rest"))
    counted = F.col("counted") + F.coalesce("counted_rest", F.lit(0.0))
    return passed.drop("rest", "times").join(rest, "at", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * F.log10(F.lit(n_all + 0.5 * (v_all + 1)))).alias("base_score"),
        (counted + F.col("modelled")).alias("score"))


def op4_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
