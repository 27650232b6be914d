"""Reading source and driver tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapter, schemas

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_driver(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
                with_position: bool = False) -> DataFrame:
    """A driver table, pruned to ``columns`` right at the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    pos = schemas.position_columns(df) if with_position else []
    if columns or pos:
        return df.select(*(columns or df.columns), *pos)
    return df


@dataclass(frozen=True)
class Sources:
    """The four source tables the pipeline reads (lazy DataFrames)."""

    leads: DataFrame
    opportunities: DataFrame
    expenses_advertising: DataFrame
    expenses_salary: DataFrame

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Sources":
        """Project the driver's ``orders`` and ``customer`` into the source shapes (adapter)."""
        orders = read_driver(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"],
                             with_position=True)
        customers = read_driver(spark, sf_dir, "customer", ["c_custkey"], with_position=True)
        return cls(
            leads=adapter.leads(orders),
            opportunities=adapter.opportunities(customers),
            expenses_advertising=adapter.expenses_advertising(orders),
            expenses_salary=adapter.expenses_salary(orders),
        )

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: dict[str, str]) -> "Sources":
        """Real source tables, held against the declared schemas.

        The files' own columns are read, so a missing column is an error here
        and not a column of NULLs; types are cast to the declared ones.
        """

        def load(key: str, schema) -> DataFrame:
            df = spark.read.parquet(paths[key])
            declared = [f.name for f in schema.fields if f.name in df.columns]
            return schemas.conform(df.select(*declared, *schemas.position_columns(df)), schema)

        return cls(
            leads=load("leads", schemas.LEADS),
            opportunities=load("opportunities", schemas.OPPORTUNITIES),
            expenses_advertising=load("expenses_advertising", schemas.EXPENSES_ADVERTISING),
            expenses_salary=load("expenses_salary_and_commissions", schemas.EXPENSES_SALARY),
        )


def as_text_timestamps(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Render every TIMESTAMP/DATE column as ISO text.

    Source rows still carry the year bug (year 0024); such values are out of
    range for nanosecond-based consumers, so a source-level export shows them
    as text.
    """
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("timestamp_ntz", "timestamp"):
            out.append(F.date_format(F.col(f.name), fmt).alias(f.name))
        elif t == "date":
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
