"""Cleaning expressions for dirty source columns (Column -> Column).

Each function is a plain composition of built-in Spark functions, usable on
any column of any table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

# Formats and patterns the cleaning rules depend on.
MONTH_TEXT_FORMAT = "MMM-yy"          # 'Jan-24'
CURRENCY_PREFIX = "US$"
# a plain decimal number; what a tolerant numeric cast accepts
DECIMAL_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def fixed_year(year: Column) -> Column:
    """The year with its first (thousands) digit set to 2: 0024 -> 2024.

    For a four-digit year this is ``2000 + year % 1000``; clean years
    (2000-2999) are unchanged.
    """
    return F.lit(2000) + F.pmod(year, F.lit(1000))


def fix_year_ts(c: str | Column) -> Column:
    """Replace the first digit of the year with 2 (0024 -> 2024), keep ms.

    Same result as rewriting the text 'YYYY-MM-DD HH24:MI:SS.FF3' and parsing
    it back, computed from the calendar fields instead of formatting and
    parsing text (several times cheaper per row).  Sub-millisecond digits are
    cut; a 29 February that does not exist in the new year raises, as a
    failed parse does.
    """
    t = col(c)
    secs = (F.floor(F.date_part(F.lit("SECOND"), t) * F.lit(1000)) / F.lit(1000)).cast("decimal(16,6)")
    return F.make_timestamp_ntz(fixed_year(F.year(t)), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), secs)


def fix_year_date(c: str | Column) -> Column:
    """Date form of ``fix_year_ts``."""
    d = col(c)
    return F.make_date(fixed_year(F.year(d)), F.month(d), F.dayofmonth(d))


def tolerant_double(text: Column) -> Column:
    """Cast text to DOUBLE, NULL when it is not a decimal number (blanks around it, an open point and an exponent are)."""
    return F.when(text.rlike(DECIMAL_PATTERN), text.try_cast("double"))


def parse_currency(c: str | Column) -> Column:
    """'US$    55 779,40' -> 55779.4.

    Drops the prefix, then every character but digits and the comma, then
    reads the comma as the decimal point.  Like the rule it mirrors, a minus
    sign and a dot are dropped too ('-5,00' -> 5.0, '55779.40' -> 5577940.0).
    """
    digits = F.regexp_replace(F.replace(col(c), F.lit(CURRENCY_PREFIX), F.lit("")), r"[^0-9,]", "")
    return tolerant_double(F.replace(digits, F.lit(","), F.lit(".")))


def exact_currency(c: str | Column) -> Column:
    """The amount of :func:`parse_currency` as DECIMAL(38,10), straight from its digits.

    No DOUBLE lies between, so 28 digits before the comma and ten after it stay as
    written, and a row costs one parse.
    """
    digits = F.regexp_replace(F.replace(col(c), F.lit(CURRENCY_PREFIX), F.lit("")), r"[^0-9,]", "")
    return exact_decimal(F.replace(digits, F.lit(","), F.lit(".")))


def exact_decimal(c: str | Column) -> Column:
    """A plain number's text as DECIMAL(38,10); text that is none -> NULL."""
    return F.when(col(c).rlike(DECIMAL_PATTERN), col(c).try_cast("decimal(38,10)"))


def parse_month(c: str | Column, tolerant: bool = False) -> Column:
    """'Jan-24' -> DATE 2024-01-01.

    Raises on text that is not a month (ANSI), like the rule it mirrors;
    ``tolerant=True`` returns NULL instead.
    """
    if tolerant:
        return F.try_to_date(col(c), MONTH_TEXT_FORMAT)
    return F.to_date(col(c), MONTH_TEXT_FORMAT)


def decimal_comma(c: str | Column) -> Column:
    """'426,83' -> 426.83; anything else that is not a number -> NULL."""
    return tolerant_double(F.replace(col(c), F.lit(","), F.lit(".")))


def list_count(c: str | Column) -> Column:
    """Number of items in a Python list printed as text.

    NULL, blank and '[]' count 0.  Otherwise quotes are swapped to JSON
    quotes and None to null; the count of the JSON array, or 0 when the text
    is not a valid array (an apostrophe inside a name breaks it, like the
    rule it mirrors).
    """
    raw = col(c)
    as_json = F.replace(F.replace(raw, F.lit("'"), F.lit('"')), F.lit("None"), F.lit("null"))
    # as an item of a list of two: only a text that is one whole JSON value makes two
    one_value = F.json_array_length(F.concat(F.lit("["), as_json, F.lit(",0]"))) == 2
    counted = F.when(one_value, F.json_array_length(as_json))
    return (
        F.when(raw.isNull() | F.trim(raw).isin("[]", ""), F.lit(0))
        .otherwise(F.coalesce(counted, F.lit(0)))
        .cast("bigint")
    )


def normalize_status(c: str | Column) -> Column:
    """'Incorrect_Contact_Data' -> 'Incorrect Contact Data'."""
    return F.replace(col(c), F.lit("_"), F.lit(" "))
