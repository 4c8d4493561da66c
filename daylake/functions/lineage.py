"""Lineage and business-date columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the business date is the 8 digits right before ".csv".
NAME_DATE = r"(\d{8})\.csv$"


def name_date(file_name: Column) -> Column:
    """8-digit date at the end of a file name, or '' when there is none."""
    return F.regexp_extract(file_name, NAME_DATE, 1)


def with_date_parts(df: DataFrame, ymd: str = "year_month_day") -> DataFrame:
    """Add zero-padded ``year``, ``month``, ``day`` strings from ``ymd``."""
    return df.withColumns({
        "year": F.substring(ymd, 1, 4),
        "month": F.substring(ymd, 5, 2),
        "day": F.substring(ymd, 7, 2),
    })
