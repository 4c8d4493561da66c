"""Key-based table changes as plain DataFrame algebra.

``MERGE`` (matched -> update all, not matched -> insert all) with a source
that has one row per key is exactly: the target rows whose key is not in the
source, plus every source row. The join is written as ``left_anti``;
Catalyst does not turn a left join + ``IS NULL`` into one (SURVEY J2).
Keys compare with ``=``, so a NULL key never matches (D14). The anti join
returns the target's columns only, so the "keep one side's columns" step
after an outer join (P8) is not needed; ``merge_condition`` gives the
aliased SQL form ``target.k = delta.k`` (P9) for callers that join in SQL.

These functions leave the join strategy to Catalyst/AQE. The table-level
upsert in ``daylake.plans.publish`` adds the size-checked broadcast and the
partition-scoped rewrite.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_key(keys: Sequence[str]) -> Column:
    """True for rows with a NULL in a key column: they match nothing."""
    return reduce(or_, [F.col(k).isNull() for k in keys])


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with no source row of the same key.

    Rows with a NULL key never match; they go past the join, so that they do
    not all hash to one reducer."""
    keyed = target.where(~null_key(keys)).join(source.select(*keys), list(keys), "left_anti")
    return keyed.select(*target.columns).unionByName(target.where(null_key(keys)))


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL matching columns by name, not by position."""
    return first.unionByName(second)


def merge_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``keys``.

    ``source`` must hold one row per key (run ``latest_per_key`` first).
    """
    return union_by_name(unmatched(target, source, keys),
                         source.select(*target.columns))


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K6: every source row replaces the target rows of its key (the gold
    publish). Same algebra as ``merge_by_key``; source keys need not be
    unique here, all source rows are kept."""
    return merge_by_key(target, source, keys)


def merge_condition(keys: Sequence[str], left: str = "target", right: str = "delta") -> str:
    """K3: ``target.k1 = delta.k1 AND ...`` for a SQL ``MERGE`` or join."""
    return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys)


def merge_on_condition(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The upsert as one join of the relations ``target`` and ``delta``
    on ``merge_condition``: matched and new rows from ``delta``, others from
    ``target``. One shuffle of both sides by key; ``merge_by_key`` moves less
    when the source is small, this one suits sources as large as the target."""
    given = source.withColumn("in_delta", F.lit(True))
    both = target.alias("target").join(given.alias("delta"), F.expr(merge_condition(keys)), "full")
    return both.select(*[F.when(F.col("delta.in_delta"), F.col(f"delta.{c}")).otherwise(F.col(f"target.{c}")).alias(c)
                         for c in target.columns])
