"""Partition filters.

Written as column predicates on the partition columns, so the scan shows
them under ``PartitionFilters`` and opens only the matching folders. A
Python lambda over rows would hide them from the optimizer.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.functions.dates import split_day

DAY_PARTS = ("year", "month", "day")


def _any(conditions: list[Column]) -> Column:
    """OR as a balanced tree: thousands of conditions stay shallow."""
    while len(conditions) > 1:
        conditions = [reduce(or_, conditions[k:k + 2]) for k in range(0, len(conditions), 2)]
    return conditions[0]


def _equals(column: str, value) -> Column:
    return F.col(column).isNull() if value is None else F.col(column) == F.lit(value)


def _one_of(column: str, values: list) -> Column:
    plain = [v for v in values if v is not None]
    found = [F.col(column).isNull()] if len(plain) < len(values) else []
    if plain:
        found.append(F.col(column).isin(plain) if len(plain) > 1 else _equals(column, plain[0]))
    return _any(found)


def partition_predicate(columns: Sequence[str], values: Sequence[Sequence]) -> Column:
    """Rows whose partition columns equal one of ``values``; FALSE for none.

    One form at every size, in the columns' own types: the values are grouped
    by their leading columns, which compare with ``=`` (``IS NULL`` for NULL),
    and the last column with ``IN``. Both forms reach the catalog's partition
    listing."""
    if not values:
        return F.lit(False)
    *leading, last = columns
    groups: dict[tuple, dict] = {}
    for row in values:
        groups.setdefault(tuple(row[:-1]), {})[row[-1]] = None
    return _any([reduce(and_, [_equals(c, v) for c, v in zip(leading, lead)] + [_one_of(last, list(lasts))])
                 for lead, lasts in groups.items()])


def partition_filter(df: DataFrame, columns: Sequence[str], values: Sequence) -> DataFrame:
    """Keep rows whose partition columns equal ``values`` (one tuple)."""
    return df.where(partition_predicate(columns, [tuple(values)]))


def day_filter(df: DataFrame, days: Sequence[str], parts: Sequence[str] = DAY_PARTS) -> DataFrame:
    """Rows of the given business days (``YYYYMMDD`` or ISO) by partition."""
    return df.where(partition_predicate(parts, [split_day(d) for d in days]))
