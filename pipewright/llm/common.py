"""Helpers shared by the operators: reading, shared scratch tables, text."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: the white space of the contracts: 0x20 and 0x09-0x0D
SPACE = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table every executor can read, so a lost executor
    costs a reread and not a recomputation.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def doc_key(column: Column) -> Column:
    """A document id that is never null: null ids count as one smallest id."""
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def row_key(text: Column) -> Column:
    """A hash of the text that tells rows of one id apart; a null text is read as the empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def null_id(column: Column) -> Column:
    """Back from :func:`doc_key`."""
    return F.when(column != NO_ID, column)


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only.  Text without other letters takes the fast path."""
    plain = F.octet_length(column) == F.char_length(column)
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of ``column`` each.

    Bounds what one numpy pass holds; a longer single text is a run by itself.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def sliced(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column, limit)
