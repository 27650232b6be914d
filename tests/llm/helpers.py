"""Small frames with odd rows, and reading of results."""

import os

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: names the operators use inside, to see that they don't clash
EXTRA = ("doc", "row", "fp", "key", "hash", "block", "part", "ids", "id", "kept", "hit", "n_words", "host", "low", "k", "n", "at", "good", "held")


def docs_of(spark, rows, extra=True):
    """rows: (doc_id, text); with clashing extra columns."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    if extra:
        for name in EXTRA:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


ODD = [(1, None), (2, ""), (None, "some words without an id at all"), (3, "same text here " * 30), (4, "same text here " * 30), (4, "same text here " * 30),
       (5, "\n\n \t\n"), (6, "ÄÖ ß 中文 \U0001F600 'll don't  x y " * 3), (7, "z" * 70_000), (8, "word " * 20_000)]


def write_tables(folder, **tables):
    for name, df in tables.items():
        df.write.parquet(os.path.join(str(folder), f"{name}.parquet"))
    return str(folder)


def rows(df):
    return [tuple(r) for r in df.collect()]
