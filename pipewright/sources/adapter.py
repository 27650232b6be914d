"""Adapter: project the driver's ``orders`` table into the four source shapes.

The driver tables hold no leads, so every lead is a deterministic function of
an ``orders`` row (``k`` = o_orderkey, ``c`` = o_custkey, ``p`` =
o_totalprice), every opportunity one of a ``customer`` row (``k`` = ten times
c_custkey, ``c`` = c_custkey), and the sources grow with the scale factor.
Both tables are used whole.  The
formulas are SQL expression text with two type placeholders so the very same
formulas run in Spark and in the DuckDB oracle (integer arithmetic and
``floor`` only, so both engines produce equal rows).

Spark builds each source in one narrow pass over its table: duplicated rows
and extra versions are generated with ``explode`` instead of a second scan.
The two expense ledgers are monthly roll-ups of ``orders`` (a partial
aggregation), written out in the dirty text formats of the real ledgers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schemas

SPARK_TYPES = {"TS": "timestamp_ntz", "STR": "string"}
DUCKDB_TYPES = {"TS": "timestamp", "STR": "varchar"}

# ----------------------------------------------------------------------
# The adapter formulas (shared with the SQL oracle).
# ----------------------------------------------------------------------
_BASE = "cast(cast(date '2024-07-10' - cast(c % 400 as int) as date) - interval 2000 year as {TS})"
_CRT = "date '2024-07-10' - cast(c % 190 as int)"

LEAD_FORMULAS = [
    ("lead_id", "cast(k as {STR})"),
    ("form_submission_date",
     "case when c % 5 < 2 and k % 7 = 0 then cast(cast(date '2024-07-10' - cast(c % 12 as int) as date)"
     " - interval 2000 year as {TS}) + case when k % 4 = 2 then interval 14 hour else interval 0 hour end"
     " when c % 5 < 2 then {BASE} end"),
    ("first_sales_call_date",
     "case when k % 7 <> 0 then {BASE} + case k % 7 when 1 then interval 3 minute"
     " when 2 then interval 12 minute when 3 then interval 45 minute when 4 then interval 33 hour"
     " when 5 then interval 100 hour else interval 20 hour end end"),
    ("first_text_sent_date", "case when k % 21 in (4, 8) then {BASE} + interval 26 hour end"),
    ("first_meeting_booked_date", "case when k % 10 in (3, 4) then {BASE} + interval 50 hour end"),
    ("last_sales_call_date", "case when k % 7 <> 0 then {BASE} + interval 120 hour end"),
    ("last_sales_activity_date",
     "case when k % 6 <> 1 then cast(cast(date '2024-07-10' - cast(c % 150 as int) as date)"
     " - interval 2000 year as {TS}) end"),
    ("last_sales_email_date", "case when k % 5 = 0 then {BASE} + interval 30 hour end"),
    ("sales_call_count", "case when k % 11 <> 0 then k % 13 end"),
    ("sales_text_count", "case when k % 3 <> 0 then k % 5 end"),
    ("sales_email_count", "case when k % 2 <> 0 then k % 4 end"),
    ("predicted_sales_with_owner",
     "case when k % 8 = 0 then null when k % 151 = 5 then 'n/a' when k % 151 = 7 then '5,' when k % 151 = 9 then '1e3'"
     " when k % 151 = 6 then concat(' ', cast(cast(floor(p / 20) as bigint) as {STR}), ',', lpad(cast(k % 1000 as {STR}), 3, '0'), ' ') else concat(cast(cast(floor(p / 20)"
     " as bigint) as {STR}), ',', lpad(cast(k % 100 as {STR}), 2, '0')) end"),
    ("marketplaces_used",
     "case when k % 9 = 0 then null when k % 9 = 1 then '[]' when k % 9 = 2 then '[None]'"
     " when k % 9 = 3 then replace('[\"Wendy~s\"]', '~', chr(39))"
     " else replace('[~Grubhub~, ~Uber Eats~]', '~', chr(39)) end"),
    ("online_ordering_used",
     "case when k % 4 = 0 then '' when k % 4 = 1 then replace('[~Own site~]', '~', chr(39)) else '[]' end"),
    ("cuisine_types",
     "case when k % 6 = 0 then 'not a list' when k % 66 = 7 then '[1] x [2]'"
     " when k % 66 = 13 then replace(concat('[~Thai~,', chr(10), '~BBQ~]'), '~', chr(39)) else replace('[~Thai~, ~Pizza~, ~BBQ~]', '~', chr(39)) end"),
    ("location_count", "k % 5 + 1"),
    ("connected_with_decision_maker", "case when k % 17 = 0 then null else k % 4 = 0 end"),
    ("status",
     "case when k % 97 = 1 then 'Incorrect_Contact_Data' when k % 10 in (3, 4) then 'Converted'"
     " when k % 2 = 0 then 'Working' when k % 3 = 0 then 'New' else 'Disqualified' end"),
    ("converted_opportunity_id",
     "case when k % 10 = 3 and (k - 3) % 130 <> 0 then cast(k - 3 as {STR})"
     " when k % 200 = 4 then cast(k - 4 as {STR}) end"),
]
# rows with this property appear twice (exact duplicates)
LEAD_DUPLICATE_RULE = "k % 50 = 0"

OPPORTUNITY_KEY = "c_custkey * 10"
OPPORTUNITY_FORMULAS = [
    ("opportunity_id", "cast(k as {STR})"),
    ("stage_name",
     "case when k % 100 < 20 then 'Closed Won' when k % 100 < 70 then 'Closed Lost'"
     " when k % 100 = 70 then 'Demo Set' when k % 400 = 80 then 'Interest'"
     " when k % 400 = 180 then 'In Progress' when k % 400 = 280 then 'Verbal Commitment'"
     " when k % 100 = 80 then 'Qualified' when k % 200 = 90 then 'On Hold' else 'Interest' end"),
    ("lost_reason_c",
     "case when k % 100 >= 20 and k % 100 < 70 then case k % 9 when 0 then 'No Demo Held'"
     " when 1 then 'Non-Responsive' when 2 then 'Lack of Urgency' when 3 then 'Price'"
     " when 4 then 'Lost to Competitor' when 5 then 'POS Integration' when 6 then 'Bad Fit'"
     " when 7 then 'Not a Decision Maker' else 'No Decision / Non-Responsive' end end"),
    ("closed_lost_notes_c", "cast(null as {STR})"),
    ("business_issue_c", "cast(null as {STR})"),
    ("how_did_you_hear_about_us_c", "case when k % 110 = 0 then 'Referral' end"),
    ("created_date", "cast({CRT} as {TS}) + interval 15 hour"),
    ("demo_held", "case when k % 70 = 0 then null else k % 30 <> 0 end"),
    ("demo_set_date",
     "case when k % 40 <> 0 then cast(cast({CRT} + cast(k % 9 as int) as date) - interval 2000 year as date) end"),
    ("demo_time",
     "case when k % 40 <> 0 then cast(cast({CRT} + cast(k % 9 as int) as date) - interval 2000 year as {TS})"
     " + interval 11 hour end"),
    ("close_date",
     "case when k % 100 < 70 then cast(cast({CRT} + cast(k % 60 as int) as date) - interval 2000 year as date) end"),
    ("last_sales_call_date_time", "cast(cast({CRT} as date) - interval 2000 year as {TS}) + interval 16 hour"),
    ("account_id", "cast(c as {STR})"),
]
# extra versions of an opportunity: an older 'Interest' copy (loses the
# dedupe) and a copy without created_date (wins it: NULL sorts first DESC)
OPPORTUNITY_OLDER_VERSION_RULE = "k % 170 = 0"
OPPORTUNITY_NULL_VERSION_RULE = "k % 510 = 0"
OLDER_VERSION_STAGE = "'Interest'"
OLDER_VERSION_CREATED = "cast({CRT} as {TS}) + interval 15 hour - interval 1 day"

# expense ledgers: every order is in one of the five months of each ledger
ADVERTISING_BUCKET = "k % 5"           # January to May
SALARY_BUCKET = "k % 5 + 1"            # February to June
MONTH_TEXT = ("case b when 0 then 'Jan-24' when 1 then 'Feb-24' when 2 then 'Mar-24'"
              " when 3 then 'Apr-24' when 4 then 'May-24' else 'Jun-24' end")
ADVERTISING_CENTS = "sum(k % 1000) * 3"
OUTBOUND_CENTS = "sum(c % 1000) * 2"
INBOUND_CENTS = "sum((k + c) % 1000) * 2"
ADVERTISING_NULL_MONTH = "b = 3"       # April amount missing
ADVERTISING_DUPLICATE = "b = 1"        # February row exported twice
SALARY_DUPLICATE = "b = 2"             # March row exported twice
MONEY_TEXT_PREFIX = "US$    "


def render(template: str, types: dict[str, str]) -> str:
    base = _BASE.format(**types)
    crt = _CRT
    return template.format(BASE=base, CRT=crt, **types)


def money_text_sql(cents: str, engine: str) -> str:
    """'US$    55 779,40' from an integer number of cents."""
    dollars = f"cast(floor({cents} / 100) as bigint)"
    grouped = (f"format_number({dollars}, 0)" if engine == "spark"
               else f"format('{{:,}}', {dollars})")
    return (f"concat('{MONEY_TEXT_PREFIX}', replace({grouped}, ',', ' '), ',', "
            f"lpad(cast({cents} % 100 as {'string' if engine == 'spark' else 'varchar'}), 2, '0'))")


def _kcp(orders: DataFrame) -> DataFrame:
    pos = list(schemas.POSITION) if schemas.has_position(orders) else []
    return orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("p"), *pos
    )


def _derived_position(z: DataFrame, index: str) -> list:
    """Position of a generated row: its order's position, refined by the copy
    or version index (so every generated row has its own)."""
    if not schemas.has_position(z):
        return []
    file_col, row_col = schemas.POSITION
    return [F.col(file_col), (F.col(row_col) * F.lit(4) + F.col(index)).alias(row_col)]


def leads(orders: DataFrame) -> DataFrame:
    """One lead per order; the duplicate rule doubles a row with ``explode``."""
    z = _kcp(orders)
    copies = F.explode(F.sequence(F.lit(1), F.expr(f"case when {LEAD_DUPLICATE_RULE} then 2 else 1 end")))
    z = z.select("*", copies.alias("_copy"))
    rows = z.select(*[F.expr(render(t, SPARK_TYPES)).alias(n) for n, t in LEAD_FORMULAS],
                    *_derived_position(z, "_copy"))
    return schemas.conform(rows, schemas.LEADS)


def opportunities(customers: DataFrame) -> DataFrame:
    """Every customer is an opportunity, some with extra versions."""
    pos = list(schemas.POSITION) if schemas.has_position(customers) else []
    z = customers.select(F.expr(OPPORTUNITY_KEY).alias("k"), F.col("c_custkey").alias("c"), *pos)
    versions = F.expr(
        f"filter(array(0, case when {OPPORTUNITY_OLDER_VERSION_RULE} then 1 end,"
        f" case when {OPPORTUNITY_NULL_VERSION_RULE} then 2 end), x -> x is not null)"
    )
    z = z.select("*", F.explode(versions).alias("v"))
    exprs = []
    for name, template in OPPORTUNITY_FORMULAS:
        sql = render(template, SPARK_TYPES)
        if name == "stage_name":
            sql = f"case when v = 1 then {OLDER_VERSION_STAGE} else {sql} end"
        elif name == "created_date":
            older = render(OLDER_VERSION_CREATED, SPARK_TYPES)
            sql = f"case v when 1 then {older} when 2 then cast(null as timestamp_ntz) else {sql} end"
        exprs.append(F.expr(sql).alias(name))
    return schemas.conform(z.select(*exprs, *_derived_position(z, "v")), schemas.OPPORTUNITIES)


def _ledger(orders: DataFrame, bucket: str, **sums: str) -> DataFrame:
    """Ledger amounts per month bucket, in one partial aggregation."""
    z = _kcp(orders).selectExpr("k", "c", f"{bucket} AS b")
    return z.groupBy("b").agg(*[F.expr(e).alias(n) for n, e in sums.items()])


def _with_copies(df: DataFrame, duplicate_rule: str) -> DataFrame:
    copies = F.explode(F.sequence(F.lit(1), F.expr(f"case when {duplicate_rule} then 2 else 1 end")))
    return df.select("*", copies.alias("_copy")).drop("_copy")


def expenses_advertising(orders: DataFrame) -> DataFrame:
    m = _with_copies(_ledger(orders, ADVERTISING_BUCKET, ad=ADVERTISING_CENTS), ADVERTISING_DUPLICATE)
    out = m.selectExpr(
        f"{MONTH_TEXT} AS month",
        f"case when {ADVERTISING_NULL_MONTH} then cast(null as string) else {money_text_sql('ad', 'spark')} end"
        " AS advertising",
    )
    return schemas.conform(out, schemas.EXPENSES_ADVERTISING)


def expenses_salary(orders: DataFrame) -> DataFrame:
    m = _with_copies(_ledger(orders, SALARY_BUCKET, outb=OUTBOUND_CENTS, inb=INBOUND_CENTS), SALARY_DUPLICATE)
    out = m.selectExpr(
        f"{MONTH_TEXT} AS month",
        f"{money_text_sql('outb', 'spark')} AS outbound_sales_team",
        f"{money_text_sql('inb', 'spark')} AS inbound_sales_team",
    )
    return schemas.conform(out, schemas.EXPENSES_SALARY)
