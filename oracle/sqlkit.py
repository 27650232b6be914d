"""Small SQL-text helpers for the DuckDB oracle.

They spell out, in SQL, the same numeric conventions the Spark code uses:
half-away rounding on doubles, money summed as decimals, NULLIF guards.
"""

from __future__ import annotations


def dbl(e: str) -> str:
    return f"CAST(({e}) AS DOUBLE)"


def rnd(e: str, d: int = 0) -> str:
    s = f"{float(10 ** d)!r}::DOUBLE"
    x = dbl(e)
    return f"(sign({x}) * floor(abs({x}) * {s} + 0.5::DOUBLE) / {s})"


def sdiv(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF(({b}), 0))"


def pct(a: str, b: str, d: int = 2) -> str:
    return rnd(sdiv(f"{dbl(a)} * 100.0::DOUBLE", b), d)


def dec(e: str) -> str:
    """The digits a DOUBLE prints as, as a decimal."""
    return f"CAST(CAST({dbl(e)} AS VARCHAR) AS DECIMAL(38,10))"


def from_dec(e: str) -> str:
    """The DOUBLE nearest to a decimal."""
    return f"CAST(CAST({e} AS VARCHAR) AS DOUBLE)"


def esum(e: str) -> str:
    return from_dec(f"SUM({dec(e)})")


def emean(e: str) -> str:
    return f"({esum(e)} / NULLIF(COUNT({e}), 0))"


def mean(e: str) -> str:
    return f"(CAST(SUM({e}) AS DOUBLE) / NULLIF(COUNT({e}), 0))"


def cif(cond: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def fix_ts(c: str) -> str:
    fmt = "'%Y-%m-%d %H:%M:%S.%g'"
    return f"strptime('2' || substr(strftime({c}, {fmt}), 2), {fmt})"


def fix_date(c: str) -> str:
    fmt = "'%Y-%m-%d'"
    return f"CAST(strptime('2' || substr(strftime({c}, {fmt}), 2), {fmt}) AS DATE)"


NUM_RE = r"'^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$'"


def tolerant_double(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, {NUM_RE}) THEN TRY_CAST({x} AS DOUBLE) END)"


def currency(c: str) -> str:
    digits = f"replace(regexp_replace(replace({c}, 'US$', ''), '[^0-9,]', '', 'g'), ',', '.')"
    return tolerant_double(digits)


def exact_currency(c: str) -> str:
    digits = f"replace(regexp_replace(replace({c}, 'US$', ''), '[^0-9,]', '', 'g'), ',', '.')"
    return f"(CASE WHEN regexp_matches({digits}, {NUM_RE}) THEN TRY_CAST({digits} AS DECIMAL(38,10)) END)"


def decimal_comma(c: str) -> str:
    return tolerant_double(f"replace({c}, ',', '.')")


def list_count(c: str) -> str:
    j = f"replace(replace({c}, '''', '\"'), 'None', 'null')"
    return (f"CAST(CASE WHEN {c} IS NULL OR trim({c}) IN ('[]', '') THEN 0 ELSE coalesce("
            f"CASE WHEN json_valid({j}) AND json_type({j}) = 'ARRAY' THEN json_array_length({j}) END, 0) END"
            f" AS BIGINT)")


def ddiff(a: str, b: str) -> str:
    return f"CAST(date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE)) AS BIGINT)"


def mdiff(a: str, b: str) -> str:
    return f"CAST(date_diff('minute', {a}, {b}) AS BIGINT)"


def hdiff(a: str, b: str) -> str:
    return f"CAST(date_diff('hour', {a}, {b}) AS BIGINT)"


def month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def week(c: str) -> str:
    return f"CAST(date_trunc('week', {c}) AS DATE)"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def date_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"
