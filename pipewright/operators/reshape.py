"""Wide <-> long reshaping in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_groups(df: DataFrame, ids: Sequence[str], label_col: str,
                   groups: Sequence[tuple[str, dict[str, str]]]) -> DataFrame:
    """Turn column groups into rows: one output row per input row and group.

    ``groups`` is ``[(label, {output_name: input_column, ...}), ...]``; every
    group maps the same output names.  Written as one ``stack`` so the input
    is scanned once (a UNION ALL of projections would scan it per group).
    """
    names = list(groups[0][1].keys())
    for _, mapping in groups:
        assert list(mapping.keys()) == names, "every group must map the same outputs"
    args = []
    for label, mapping in groups:
        args.append(F.lit(label))
        args.extend(F.col(mapping[n]) for n in names)
    stacked = F.stack(F.lit(len(groups)), *args).alias(label_col, *names)
    return df.select(*ids, stacked)


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                    name_col: str = "measure", value_col: str = "value") -> DataFrame:
    """Plain unpivot of same-typed columns (``DataFrame.unpivot``)."""
    return df.unpivot(list(ids), list(columns), name_col, value_col)
