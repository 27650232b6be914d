"""Column -> Column functions (built-in Spark expressions only)."""

from .buckets import lookup, lower_bucket, upper_bucket
from .clean import (decimal_comma, exact_currency, exact_decimal, fix_year_date, fix_year_ts, list_count, normalize_status,
                    parse_currency, parse_month, tolerant_double)
from .numeric import (count_if, exact_mean, exact_mean_of, exact_sum, mean, money, pct, round_half,
                      safe_div)
from .timefn import (date_literal, day_diff, epoch_seconds, hour_diff, minute_diff, month_start,
                     ts_literal, week_start)

__all__ = [
    "lookup", "lower_bucket", "upper_bucket",
    "decimal_comma", "exact_currency", "exact_decimal", "fix_year_date", "fix_year_ts", "list_count", "normalize_status",
    "parse_currency", "parse_month", "tolerant_double",
    "count_if", "exact_mean", "exact_mean_of", "exact_sum", "mean", "money", "pct", "round_half", "safe_div",
    "date_literal", "day_diff", "epoch_seconds", "hour_diff", "minute_diff", "month_start",
    "ts_literal", "week_start",
]
