"""Aggregate by function name."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions a caller may name. All are one-column aggregates whose state per
# group is bounded; collecting functions (collect_set, collect_list) are left
# out because one hot group would gather unbounded data in one task, and
# first / last because without an order they name no particular row.
ALLOWED = {
    "count": F.count,
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "any_value": F.any_value,
    "bool_and": F.bool_and,
    "bool_or": F.bool_or,
    "stddev": F.stddev,
    "stddev_pop": F.stddev_pop,
    "stddev_samp": F.stddev_samp,
    "variance": F.variance,
    "var_pop": F.var_pop,
    "var_samp": F.var_samp,
    "skewness": F.skewness,
    "kurtosis": F.kurtosis,
    "countDistinct": F.count_distinct,
    "count_distinct": F.count_distinct,
    "approx_count_distinct": F.approx_count_distinct,
}


def aggregate_by_name(df: DataFrame, groups: Sequence[str],
                      aggs: Sequence[tuple[str, str]]) -> DataFrame:
    """``aggs`` is a list of ``(column, function)``; output columns are the
    groups then ``<function>_<column>``. No groups = one global row."""
    exprs = []
    for column, func in aggs:
        if func not in ALLOWED:
            raise ValueError(f"aggregate {func!r} not allowed; use one of {sorted(ALLOWED)}")
        exprs.append(ALLOWED[func](column).alias(f"{func}_{column}"))
    grouped = df.groupBy(*groups) if groups else df
    return grouped.agg(*exprs)


def earliest_value(df: DataFrame, column: str) -> DataFrame:
    """A2 made deterministic (D3): one row, ``first_<column>`` = the minimum."""
    return df.agg(F.min(column).alias(f"first_{column}"))


def rows_at_earliest(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` equals its minimum, as an inner join with the
    one-row ``earliest_value`` frame. That frame has exactly one row, so the
    broadcast is bounded by construction. On a partitioned table prefer a
    literal partition filter (``jobs.earliest_day``): the join does not
    prune partitions."""
    first = earliest_value(df, column)
    return df.join(F.broadcast(first), df[column] == first[f"first_{column}"], "inner") \
             .drop(f"first_{column}")
