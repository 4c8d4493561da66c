"""What a landed table looks like: its raw columns, mappings and key."""

from __future__ import annotations

from dataclasses import dataclass, field

from daylake.functions.mapping import (BRONZE_DROP, BRONZE_POLICY, GOLD_POLICY,
                                       RAW_POLICY, Field)
from daylake.sources.landing import RFC4180

PARTITIONS = ["year", "month", "day"]


@dataclass(frozen=True)
class Dataset:
    name: str
    raw_columns: list[str]
    bronze_mapping: list[Field]
    keys: list[str]
    gold_mapping: list[Field]
    bronze_drop: list[str] = field(default_factory=list)
    order_by: list[str] = field(default_factory=lambda: ["year_month_day desc"])
    partitions: list[str] = field(default_factory=lambda: list(PARTITIONS))
    table_format: str = "parquet"   # "delta" / "iceberg" where installed: MERGE INTO
    csv_options: dict = field(default_factory=dict)  # beside landing.CSV_OPTIONS
    bind_by_header: bool = False    # columns by the header's names, not by position (D8)
    quarantine: bool = False        # bad rows go to <table>_rejected instead of the table (D9)
    key_index: bool = False         # index the table's keys, for upserts of few keys
    retention_hours: float = 0.0    # how long superseded files stay, for readers of older versions


POLICY = Dataset("policy", RAW_POLICY, BRONZE_POLICY, ["policy_id"], GOLD_POLICY,
                 bronze_drop=BRONZE_DROP)

# The driver's ``events`` table standing in for policy changes: one change
# row per event, the key is the user.
EVENTS = Dataset(
    "events",
    ["event_id", "ts", "user_id", "event_type", "value", "props"],
    [Field("event_id", "event_id", "bigint"),
     Field("ts", "ts", "timestamp_ntz"),
     Field("user_id", "user_id", "bigint"),
     Field("event_type", "event_type", "string"),
     Field("value", "value", "double"),
     Field("props", "props", "string")],
    ["user_id"],
    [Field("event_id", "event_id", "bigint"),
     Field("ts", "ts", "timestamp_ntz"),
     Field("user_id", "user_id", "bigint"),
     Field("event_type", "event_type", "string"),
     Field("value", "value", "double"),
     Field("file_name", "file_name", "string"),
     Field("year_month_day", "year_month_day", "string"),
     Field("year", "year", "string"),
     Field("month", "month", "string"),
     Field("day", "day", "string")],
    csv_options=RFC4180,
)
