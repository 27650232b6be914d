"""Declared schemas of the four source tables.

Sources are read with these schemas and checked on read; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

TS = TimestampNTZType()

LEADS = StructType([
    StructField("lead_id", StringType(), False),
    StructField("form_submission_date", TS),
    StructField("first_sales_call_date", TS),
    StructField("first_text_sent_date", TS),
    StructField("first_meeting_booked_date", TS),
    StructField("last_sales_call_date", TS),
    StructField("last_sales_activity_date", TS),
    StructField("last_sales_email_date", TS),
    StructField("sales_call_count", LongType()),
    StructField("sales_text_count", LongType()),
    StructField("sales_email_count", LongType()),
    StructField("predicted_sales_with_owner", StringType()),
    StructField("marketplaces_used", StringType()),
    StructField("online_ordering_used", StringType()),
    StructField("cuisine_types", StringType()),
    StructField("location_count", LongType()),
    StructField("connected_with_decision_maker", BooleanType()),
    StructField("status", StringType()),
    StructField("converted_opportunity_id", StringType()),
])

OPPORTUNITIES = StructType([
    StructField("opportunity_id", StringType(), False),
    StructField("stage_name", StringType()),
    StructField("lost_reason_c", StringType()),
    StructField("closed_lost_notes_c", StringType()),
    StructField("business_issue_c", StringType()),
    StructField("how_did_you_hear_about_us_c", StringType()),
    StructField("created_date", TS),
    StructField("demo_held", BooleanType()),
    StructField("demo_set_date", DateType()),
    StructField("demo_time", TS),
    StructField("close_date", DateType()),
    StructField("last_sales_call_date_time", TS),
    StructField("account_id", StringType()),
])

EXPENSES_ADVERTISING = StructType([
    StructField("month", StringType()),
    StructField("advertising", StringType()),
])

EXPENSES_SALARY = StructType([
    StructField("month", StringType()),
    StructField("outbound_sales_team", StringType()),
    StructField("inbound_sales_team", StringType()),
])

ALL = {
    "leads": LEADS,
    "opportunities": OPPORTUNITIES,
    "expenses_advertising": EXPENSES_ADVERTISING,
    "expenses_salary_and_commissions": EXPENSES_SALARY,
}


# Physical position of a source row: hash of its file path and its row index
# in that file.  Carried next to the declared columns (never part of a
# model's output) as the deterministic tie-break of the dedupes: it needs no
# data column, so column pruning still reaches the Parquet scan.
POSITION = ("_pos_file", "_pos_row")


def position_columns(df: DataFrame) -> list:
    """The position of each row of a freshly read file-source DataFrame."""
    return [F.xxhash64(F.col("_metadata.file_path")).alias(POSITION[0]),
            F.col("_metadata.row_index").alias(POSITION[1])]


def has_position(df: DataFrame) -> bool:
    return all(c in df.columns for c in POSITION)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to exactly the declared columns and types.

    Missing columns raise; integer keys are accepted and cast to text.  The
    row position columns, when present, are kept.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"source is missing columns {missing}")
    extra = list(POSITION) if has_position(df) else []
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)
