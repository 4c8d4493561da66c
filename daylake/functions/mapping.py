"""Typed mappings: rename + cast + keep only the listed columns.

Casts use ``try_cast``: a malformed value becomes NULL instead of failing
the job (D9), and ``cast_failures`` counts those values per column so that
the run report can show them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class Field:
    source: str
    target: str
    type: str = "string"


def raw_schema(names: Iterable[str]) -> StructType:
    """All-string, nullable schema for a landing file (S3)."""
    return StructType([StructField(n, StringType(), True) for n in names])


def _typed(f: Field) -> Column:
    col = F.col(f.source)
    if f.type == "string":
        return col.cast("string").alias(f.target)
    return col.try_cast(f.type).alias(f.target)


def apply_mapping(df: DataFrame, mapping: Sequence[Field],
                  keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` through ``mapping``; columns in ``keep`` pass unchanged."""
    return df.select(*[_typed(f) for f in mapping], *keep)


def cast_failures(mapping: Sequence[Field]) -> list[Column]:
    """Aggregates counting values that were present but did not cast."""
    out = []
    for f in mapping:
        if f.type == "string":
            continue
        src = F.col(f.source)
        bad = src.isNotNull() & src.try_cast(f.type).isNull()
        out.append(F.count(F.when(bad, 1)).alias(f"bad_{f.target}"))
    return out


# Fixed values (same as the reference): the landing file columns, the
# raw -> bronze mapping and the bronze -> gold mapping of the policy table.
# ``char(1)`` in the reference is kept as string: Spark's char(1) cast does
# not truncate and a char(1) column rejects longer values.
RAW_POLICY = ["operation", "policy_id", "expiry_date", "location_name",
              "state_code", "region_name", "insured_value", "business_type",
              "earthquake", "flood"]

BRONZE_POLICY = [
    Field("operation", "operation", "string"),
    Field("policy_id", "policy_id", "bigint"),
    Field("expiry_date", "expiry_date", "date"),
    Field("location_name", "location_name", "string"),
    Field("state_code", "state_code", "string"),
    Field("region_name", "region_name", "string"),
    Field("insured_value", "insured_value", "double"),
    Field("business_type", "business_type", "string"),
    Field("earthquake", "earth_quake", "string"),
    Field("flood", "flood", "string"),
]

GOLD_POLICY = [
    Field("policy_id", "policy_id", "bigint"),
    Field("expiry_date", "expiry_date", "date"),
    Field("location_name", "location_name", "string"),
    Field("state_code", "state_code", "string"),
    Field("region_name", "region_name", "string"),
    Field("insured_value", "insured_value", "double"),
    Field("business_type", "business_type", "string"),
    Field("flood", "flood", "string"),
    Field("file_name", "file_name", "string"),
    Field("year_month_day", "year_month_day", "string"),
    Field("year", "year", "string"),
    Field("month", "month", "string"),
    Field("day", "day", "string"),
]

# Bronze drops the change-type column after the mapping.
BRONZE_DROP = ["operation"]
