"""Ledger of loaded landing files (S1): late files without a wider window.

The ledger is a small Parquet table of (path, size, modification time) per
loaded file, one folder per load. What is new is the anti join of the landing
folder's listing with it: a file that arrives late, or is replaced in place, is
loaded whatever its date, and a load that runs again finds nothing. A load is
recorded after the table has its rows; one that dies before that is loaded
again, which replaces the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.sources.tables import path_exists

SCHEMA = "path string, length long, modified timestamp, loaded_at timestamp"
FILE = ["path", "length", "modified"]


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(ledger)


def unloaded(spark: SparkSession, ledger: str, files: DataFrame) -> DataFrame:
    """The files of a listing (``landing.list_files``) that the ledger has not."""
    return files.join(read_ledger(spark, ledger).select(*FILE), FILE, "left_anti")


def record(spark: SparkSession, ledger: str, files: DataFrame) -> None:
    """Add files to the ledger; loads that run side by side write folders of
    their own."""
    files.select(*FILE, F.current_timestamp().alias("loaded_at")).coalesce(1).write.parquet(
        f"{ledger}/load-{uuid.uuid4().hex[:12]}")


__all__ = ["read_ledger", "unloaded", "record"]
