"""Column-level helpers: dates, names, typed mappings, lineage columns."""

from daylake.functions.dates import resolve_day, resolve_window, to_compact
from daylake.functions.lineage import with_date_parts
from daylake.functions.mapping import (BRONZE_POLICY, GOLD_POLICY, RAW_POLICY,
                                       Field, apply_mapping, cast_failures,
                                       raw_schema)
from daylake.functions.naming import snake_case, snake_case_columns

__all__ = [
    "resolve_day", "resolve_window", "to_compact", "with_date_parts",
    "Field", "apply_mapping", "cast_failures", "RAW_POLICY", "BRONZE_POLICY",
    "GOLD_POLICY", "raw_schema", "snake_case", "snake_case_columns",
]
