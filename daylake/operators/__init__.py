"""DataFrame -> DataFrame operators: dedup, upsert, aggregate, filters."""

from daylake.operators.aggregate import aggregate_by_name, earliest_value, rows_at_earliest
from daylake.operators.dedup import latest_per_key
from daylake.operators.filters import day_filter, partition_filter
from daylake.operators.upsert import (merge_by_key, replace_by_key,
                                      union_by_name, unmatched)

__all__ = ["aggregate_by_name", "earliest_value", "rows_at_earliest", "latest_per_key",
           "day_filter", "partition_filter", "merge_by_key", "replace_by_key",
           "union_by_name", "unmatched"]
