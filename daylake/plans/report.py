"""Run report (A3, R1, R2): one row per job run, and the log of them.

The log is an append-only Parquet folder. Each report is a folder of its own,
so that runs side by side, batch and stream, do not disturb each other; nothing
is ever rewritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.sources.tables import path_exists

REPORT_SCHEMA = (
    "stage string, start_date string, final_date string, source string, "
    "target string, load_kind string, qtty_before long, qtty_source long, "
    "qtty_after long, null_keys long, bad_values long, "
    "rows_dropped long, rows_quarantined long, corrupt_lines long, files_outside long, files_undated long, "
    "rows_unpublished long, partitions_rewritten long, partitions_dropped long, "
    "partitions_share double, keys_broadcast boolean"
)
FIELDS = [tuple(f.split()) for f in REPORT_SCHEMA.split(", ")]


def run_report(spark: SparkSession, **values) -> DataFrame:
    """The report row as literals over ``range(1)``: planned in the JVM, no
    Python data path."""
    unknown = set(values) - {name for name, _ in FIELDS}
    if unknown:
        raise ValueError(f"unknown report fields {sorted(unknown)}")
    return spark.range(1).select(*[F.lit(values.get(name)).cast(kind).alias(name)
                                   for name, kind in FIELDS])


LOG_SCHEMA = f"{REPORT_SCHEMA}, logged_at timestamp"


def log_report(report: DataFrame, log: str) -> None:
    """Append a report to the log folder."""
    (report.withColumn("logged_at", F.current_timestamp()).coalesce(1)
     .write.parquet(f"{log.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"))


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All reports of a log folder, with the time they were written."""
    if not path_exists(spark, log):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(log)
