"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and calls one operator of
``pipewright.llm`` on all its predecessor kept; its decisions take effect in what
it returns.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.llm import bpe, decontaminate, importance, line_dedup, simhash
from pipewright.llm.common import doc_key, row_key, table
from pipewright.session import checkpoint_dir


def _with_key(docs: DataFrame) -> DataFrame:
    """The documents with their key and the hash of their text, under names no column of theirs has."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), doc_key(F.col("doc_id")).alias("doc"),
                       row_key(F.col("text")).alias("hash"))


def _kept(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document and text are in ``decisions`` (doc, hash)."""
    return _with_key(docs).join(decisions.select("doc", "hash").distinct(), ["doc", "hash"], "left_semi").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    found = importance.resample(docs, table(spark, sf_dir, "labels"), rows_apart=True)
    return _kept(docs, found.where("kept").select("doc", F.col("row").alias("hash")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their repeated lines; n_chars follows the text."""
    found = line_dedup.drop_lines(docs).where("n_dropped > 0").select("doc", F.col("row").alias("hash"), "kept").distinct()
    joined = _with_key(docs).join(found, ["doc", "hash"], "left")
    text = F.when(F.col("kept").isNotNull(), F.col("kept")).otherwise(F.col("row.text"))
    changed = {"text": text, "n_chars": F.when(F.col("kept").isNotNull(), F.char_length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return joined.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each component that SimHash fingerprints connect."""
    found = simhash.leaders(docs).select("doc", F.col("row").alias("hash"))
    rows = _with_key(docs).join(found, ["doc", "hash"], "left_semi")
    return rows.groupBy("doc", "hash").agg(F.min("row").alias("row")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return _kept(docs, found.where(F.size("hit") == 0).select(doc_key(F.col("id")).alias("doc"), row_key(F.col("text")).alias("hash")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the tokens of each document."""
    return bpe.encode(docs).select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("byte_level_bpe", tokens),
]
#: the stages 7, 8 and 2 are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{checkpoint_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
