"""Line deduplication across documents (DataFrame functions only).

Lines are exploded, normalised and hashed; documents are counted per hash; the
lines of a hash found in ``min_docs`` documents or more go, except in the
largest document that holds it; what is left is put together by position.

Defined results: a null or empty text is one empty line; a null id counts as
one document with the smallest id; rows that repeat an id belong to one
document, and each keeps its own text; an empty table gives an empty table;
columns beside the id and the text are never looked at here.

Scale: one exchange of (hash, document) pairs, already aggregated per task, for
the distinct count, so a line that every third document holds is one row per
task and document set, not a group in one task; one join of the lines with the
hashes to drop, which adaptive execution splits where a hash is hot or
broadcasts where the hashes are few; one exchange of the texts to meet their
dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, doc_key, null_id, table

MIN_CHARS, MIN_DOCS = 20, 3


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, row, lines, kept, n_dropped): every row's kept line indices.

    ``doc`` is the id by :func:`common.doc_key`, ``row`` a hash of the text that
    tells rows of one id apart, ``text`` the whole text.
    """
    rows = docs.select(doc_key(F.col(id_col)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("row", F.xxhash64("text"))
    lines = rows.select("doc", "row", F.posexplode(split_lines(F.col("text"))).alias("pos", "line")) \
        .select("doc", "row", "pos", line_key(F.col("line")).alias("key")) \
        .where(F.char_length("key") >= min_chars) \
        .select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    repeated = lines.groupBy("h1", "h2") \
        .agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("keeper")) \
        .where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    dropped = lines.join(repeated, ["h1", "h2"]).where(F.col("doc") < F.col("keeper")) \
        .groupBy("doc", "row").agg(F.collect_set("pos").alias("dropped"))
    all_lines = split_lines(F.col("text"))
    indices = F.sequence(F.lit(0), F.size(all_lines) - 1)
    return rows.join(dropped, ["doc", "row"], "left") \
        .withColumn("n_dropped", F.coalesce(F.size("dropped"), F.lit(0)).cast("long")) \
        .withColumn("n_lines", F.size(all_lines).cast("long")) \
        .withColumn("kept", F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(
            F.array_join(F.transform(F.array_except(indices, F.col("dropped")), lambda i: all_lines[i]), "\n"))) \
        .select("doc", "row", "text", "kept", "n_lines", "n_dropped")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents")).select(
        null_id(F.col("doc")).alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE r.key IS NOT NULL AND doc_id < keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE r.key IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON k.key = r.key
GROUP BY doc_id
"""
