"""DataFrame -> DataFrame operators, parameterized by column names."""

from .checks import check_orphans, failure_count, violations
from .dedupe import dedupe, first_rows
from .quantiles import exact_median
from .reshape import unpivot_columns, unpivot_groups
from .snapshot import diff_snapshots
from .shares import count_share, share_of_total, weighted_average
from .windows import ordered, rolling_count, rolling_mean, trailing

__all__ = [
    "check_orphans", "failure_count", "violations", "dedupe", "first_rows", "exact_median",
    "unpivot_columns", "unpivot_groups", "count_share", "share_of_total", "weighted_average",
    "diff_snapshots", "ordered", "rolling_count", "rolling_mean", "trailing",
]
