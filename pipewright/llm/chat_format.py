r"""Chat formatting after cumulative-snapshot collapse.

A log often holds a conversation several times, each a prefix of the next.  The
rolling hash of a conversation's first k turns is the XOR over them of a hash of
(position, role, text), so each turn-prefix has one.  A conversation whose whole
hash is a proper prefix of another one's goes, by an anti-join; of equal
conversations the one with the smallest id stays.  The rest is rendered.

Defined results: turns are taken in the order of (turn, role, text), nulls first;
a null role or text is a value of its own, unlike the empty one, and is rendered
as the empty text; rows that repeat a whole turn are one turn; a null id is one
conversation, returned without an id; an empty table gives an empty one.

Scale: one exchange of turns by conversation, sorted there; then only hashes
move.  Prefix hashes are made distinct in each task first, so a first turn, or a
whole conversation, that a third of the log shares is one row a task.  The turns
of one conversation meet in one row, as its rendered text is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import doc_key, null_id, stored, table

TURN_START, ROLE_END, TURN_END = "<|im_start|>", "\n", "<|im_end|>\n"


def prefixes(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, k, n, role, text, h1, h2): each turn, with the rolling hashes of the first k of n turns."""
    rows = turns.select(doc_key(F.col(id_col)).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text")).distinct()
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # null flags, as xxhash64 passes over nulls
    turn = [F.col("k"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return rows.withColumn("k", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(whole)) \
        .withColumn("t1", F.xxhash64(*turn)).withColumn("t2", F.xxhash64(F.lit(1), *turn)) \
        .select("conv", "k", "n", "role", "text", F.bit_xor("t1").over(so_far).alias("h1"), F.bit_xor("t2").over(so_far).alias("h2"))


def collapse(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv, n, hashes of the whole) of the maximal conversations."""
    rows = prefixes(turns, **columns).select("conv", "k", "n", "h1", "h2")
    whole = rows.where("k = n").groupBy("n", "h1", "h2").agg(F.min("conv").alias("conv"))
    proper = rows.where("k < n").select(F.col("k").cast("long").alias("n"), "h1", "h2").distinct()
    return whole.join(proper, ["n", "h1", "h2"], "left_anti").select("conv", "n")


def render(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv, n_turns, text) of the maximal conversations; conv by :func:`common.doc_key`."""
    rows = prefixes(turns, **columns)
    line = F.concat(F.lit(TURN_START), F.coalesce("role", F.lit("")), F.lit(ROLE_END), F.coalesce("text", F.lit("")), F.lit(TURN_END))
    kept = stored(collapse(turns, **columns), "maximal")
    return rows.select("conv", "k", line.alias("line")).join(kept.select("conv"), "conv", "left_semi") \
        .groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("k", "line"))).alias("lines")) \
        .select("conv", F.size("lines").cast("long").alias("n_turns"), F.array_join("lines.line", "").alias("text"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations")).select(null_id(F.col("conv")).alias("conv_id"), "n_turns", "text")


SQL = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations),
convs AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS t FROM turns GROUP BY conv_id),
proper AS (
  SELECT DISTINCT list_slice(t, 1, k) AS t FROM (SELECT t, unnest(generate_series(1, len(t) - 1)) AS k FROM convs WHERE len(t) > 1)),
maximal AS (
  SELECT min(conv_id) AS conv_id, t FROM convs WHERE t NOT IN (SELECT t FROM proper) GROUP BY t)
SELECT conv_id, CAST(len(t) AS BIGINT) AS n_turns,
       array_to_string(['<|im_start|>' || coalesce(x.role, '') || chr(10) || coalesce(x.text, '') || '<|im_end|>' || chr(10) for x in t], '') AS text
FROM maximal
"""
