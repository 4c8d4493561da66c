"""CDC files -> bronze with Structured Streaming (S4, K2 as micro-batches).

``readStream`` over ``cdc-load/`` (CSV, ``*.csv``, recursive) feeds
``foreachBatch``; every micro-batch goes through the same steps as the
batch job: typed mapping, lineage, staging, latest row per key,
partition-scoped upsert. The file source records which files it has read in
the checkpoint. A batch that runs again replaces what it wrote: keyed rows by
their key, NULL-key rows by their file.

The table must exist: its first load reads ``full-load/`` with the batch job.
A row of an older file never replaces one of a newer file, so neither the
order in which files arrive nor ``max_files_per_trigger`` changes the result.
Every dated file is loaded, whatever its date; files without a date in their
name are counted in the report of their batch (``files_undated``), and not
loaded: renamed, they are new files.

``trigger(availableNow=True)`` (the default here) reads everything new and
stops, which is how a scheduled job uses it; pass ``processing_time`` for a
long-running stream. ``on_report`` gets each batch's run report, ``log`` is a
folder it is appended to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from daylake.functions.lineage import name_date
from daylake.functions.mapping import raw_schema
from daylake.plans.datasets import Dataset
from daylake.plans.jobs import CDC_LOAD, load_bronze
from daylake.plans.report import log_report, run_report
from daylake.session import remove_folder, run_folder
from daylake.sources.landing import CORRUPT, CSV_OPTIONS
from daylake.sources.tables import table_exists


def stream_to_bronze(spark: SparkSession, ds: Dataset, landing_root: str, table: str,
                     checkpoint: str, max_files_per_trigger: int | None = None,
                     processing_time: str | None = None,
                     on_report: Callable[[DataFrame], None] | None = None,
                     log: str | None = None) -> StreamingQuery:
    if not table_exists(spark, table):
        raise ValueError(f"{table} does not exist: run its first load (full-load/) before the stream")
    source = f"{landing_root.rstrip('/')}/{CDC_LOAD}"
    schema = StructType([*raw_schema(ds.raw_columns).fields, StructField(CORRUPT, StringType(), True)])
    reader = (spark.readStream.schema(schema).options(**CSV_OPTIONS)
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
              .options(**ds.csv_options))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    ymd = name_date(F.col("_metadata.file_name"))
    rows = reader.csv(source).select(
        *ds.raw_columns, CORRUPT, F.col("_metadata.file_path").alias("file_name"), ymd.alias("year_month_day"))

    def load_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        work = run_folder(session, f"stream-{epoch}")
        dated = F.col("year_month_day") != ""
        counts = load_bronze(session, ds, batch.where(dated), table, work, newest_wins=True)
        undated = batch.where(~dated).select("file_name").distinct().count()
        remove_folder(session, work)
        # the stream runs in a cloned session: drop the caller's cached listing
        spark.catalog.refreshTable(table)
        report = run_report(spark, stage="stream", source=source, target=table, files_outside=0,
                            files_undated=undated, **counts)
        if log:
            log_report(report, log)
        if on_report:
            on_report(report)

    writer = (rows.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(processingTime=processing_time) if processing_time
              else writer.trigger(availableNow=True))
    return writer.start()


__all__ = ["stream_to_bronze"]
