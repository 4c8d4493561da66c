"""The two jobs: landing files -> bronze, bronze -> gold.

Each returns its run report as a one-row DataFrame (R1). Exceptions
propagate (D2, D16). Bronze runs: one job scans the CSV files, casts and
writes the typed rows to the run's folder in the shared workspace (counts
are observed there, in a single stage, so they stay exact when tasks are
retried); the dedup then reads that parquet. First load: one more job
writes the table. Upsert: the deduplicated rows are staged too, then the
partition-scoped upsert runs (key check, per-partition scan, rewrite).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daylake.functions.dates import resolve_day, resolve_window, split_day
from daylake.functions.lineage import with_date_parts
from daylake.functions.mapping import apply_mapping, cast_failures, raw_schema
from daylake.operators.dedup import latest_per_key
from daylake.operators.filters import day_filter
from daylake.operators.upsert import null_key
from daylake.plans.datasets import Dataset
from daylake.plans.publish import (index_keys, may_hold, partition_rows, replace_table, stage, table_location,
                                   upsert_partitions, upsert_table, write_table)
from daylake.plans.report import log_report, run_report
from daylake.session import conf_override, remove_folder, run_folder
from daylake.sources import ledger as ledgers
from daylake.sources.landing import CORRUPT, file_counts, list_files, scan_by_header, scan_dated, scan_files
from daylake.sources.tables import partition_columns, path_exists, table_exists

FULL_LOAD = "full-load"
CDC_LOAD = "cdc-load"


def conform(raw: DataFrame, ds: Dataset) -> DataFrame:
    """Typed mapping, lineage and date parts, dropped columns."""
    typed = apply_mapping(raw, ds.bronze_mapping, keep=["file_name", "year_month_day"])
    return with_date_parts(typed).drop(*ds.bronze_drop)


def _conform_with(raw: DataFrame, ds: Dataset, keep: list[str]) -> DataFrame:
    typed = apply_mapping(raw, ds.bronze_mapping, keep=["file_name", "year_month_day", *keep])
    return with_date_parts(typed).drop(*ds.bronze_drop)


def _null_keys(ds: Dataset):
    cond = F.lit(False)
    for k in ds.keys:
        cond = cond | F.col(k).isNull()
    return F.count(F.when(cond, 1)).alias("null_keys")


def problems(ds: Dataset):
    """What is wrong with a scanned row, as ``(reason, column, value)`` structs:
    a corrupt line, a value that does not cast, a key that is absent."""
    def one(reason: str, column: str | None, value):
        return F.struct(F.lit(reason).alias("reason"), F.lit(column).cast("string").alias("column"),
                        value.cast("string").alias("value"))

    found = [F.when(F.col(CORRUPT).isNotNull(), one("corrupt line", None, F.col(CORRUPT)))]
    for f in ds.bronze_mapping:
        value = F.col(f.source)
        if f.type != "string":
            found.append(F.when(value.isNotNull() & value.try_cast(f.type).isNull(), one("bad value", f.source, value)))
        if f.target in ds.keys:
            found.append(F.when(value.isNull(), one("no key", f.source, value)))
    return F.filter(F.array(*found), lambda p: p.isNotNull())


def rejected_table(table: str) -> str:
    return f"{table}_rejected"


def _split_rejected(raw: DataFrame, typed_of, ds: Dataset, path: str, observation: Observation) -> tuple:
    """One scan, one write, two folders: the typed rows to load, and the rejected
    ones with their problems and the whole line as JSON. Returns both frames;
    the rejected rows are counted in the write."""
    spark = raw.sparkSession
    bad = "rejected"
    marked = raw.withColumn("problems", problems(ds)).withColumn("line", F.to_json(F.struct(*ds.raw_columns)))
    typed = typed_of(marked, ["problems", "line"]).withColumn(bad, F.size("problems") > 0)
    good_columns = [c for c in typed.columns if c not in ("problems", "line", bad)]
    out = typed.select(*good_columns, F.when(F.col(bad), F.col("problems")).alias("problems"),
                       F.when(F.col(bad), F.col("line")).alias("line"), bad)
    out = out.observe(observation, _null_keys(ds), F.count(F.when(F.col(bad), 1)).alias("rejected"))
    # two open files a task: no sort of the rows before the write
    with conf_override(spark, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
        out.write.partitionBy(bad).parquet(path)
    schema = out.drop(bad).schema

    def side(flag: str) -> DataFrame:
        folder = f"{path}/{bad}={flag}"
        return (spark.read.schema(schema).parquet(folder) if path_exists(spark, folder)
                else spark.createDataFrame([], schema))
    return side("false").select(*good_columns), side("true").select("file_name", "problems", "line", "year_month_day")


def _rewrite_fields(stats) -> dict:
    """How much of the table an upsert rewrote (nothing for a MERGE)."""
    if not stats.partitions_rewritten and not stats.broadcast:
        return {}
    return dict(partitions_rewritten=len(stats.partitions_rewritten),
                partitions_dropped=len(stats.partitions_dropped),
                partitions_share=round(len(stats.partitions_rewritten) / max(stats.partitions_total, 1), 4),
                keys_broadcast=stats.broadcast)


def load_bronze(spark: SparkSession, ds: Dataset, raw: DataFrame, table: str, work: str,
                stage_typed: bool = True, newest_wins: bool = False,
                upsert_limits: dict | None = None) -> dict:
    """Scanned rows (with lineage and ``_corrupt_line``) -> bronze table;
    returns the report's counts. Shared by the batch and the streaming job.

    ``newest_wins`` keeps a row of the table against a source row of an older
    file date, so that the order in which files arrive cannot matter."""
    exists = table_exists(spark, table)
    seen, typed_seen = Observation("source"), Observation("typed")
    corrupt = F.count(CORRUPT) if CORRUPT in raw.columns else F.count(F.lit(None))
    observed_raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"), corrupt.alias("corrupt"),
                               *cast_failures(ds.bronze_mapping))
    observed = conform(observed_raw, ds)
    rejected, rejects = None, 0
    # Scan, cast and write in one stage: the counts observed here are exact
    # even when tasks are retried, and every later step reads parquet.
    if ds.quarantine:
        typed, rejected = _split_rejected(observed_raw, lambda df, keep: _conform_with(df, ds, keep), ds,
                                          f"{work}/typed", typed_seen)
        empty, rejects = seen.get["rows"] == 0, typed_seen.get["rejected"]
    elif stage_typed:
        typed = stage(observed, f"{work}/typed", observation=typed_seen, metrics=[_null_keys(ds)])
        empty = seen.get["rows"] == 0
    else:
        typed = observed.observe(typed_seen, _null_keys(ds))
        empty = raw.limit(1).isEmpty()  # reads at most one file
    if empty:  # R2: nothing to load, change nothing
        before = spark.table(table).count() if exists else 0
        return dict(load_kind="none", qtty_before=before, qtty_source=0, qtty_after=before,
                    null_keys=0, bad_values=0, rows_dropped=0, rows_quarantined=0, corrupt_lines=0)

    kept = Observation("kept")
    rows = [F.count(F.lit(1)).alias("rows")]
    latest = latest_per_key(typed, ds.keys, ds.order_by)
    fields: dict = {}
    if not exists:
        write_table(latest, table, ds.partitions, table_format=ds.table_format,
                    observation=kept, metrics=rows)
        kind, before, after = "first", 0, kept.get["rows"]
        if ds.key_index:
            index_keys(spark, table, ds.keys)
    else:
        if newest_wins:
            target = spark.table(table)
            if ds.key_index:    # only the partitions that may hold one of the keys
                latest = stage(latest, f"{work}/latest-given", rebalance_by=ds.partitions)
                target = may_hold(spark, table, latest, ds.keys)
            latest = _newer_than_table(target, latest, ds)
        staged = stage(latest, f"{work}/latest", rebalance_by=ds.partitions,
                       observation=kept, metrics=rows)
        stats = upsert_table(spark, table, staged, ds.keys, source_unique=True,
                             replay_by=["file_name"] if "file_name" in staged.columns else (),
                             **{"retention_hours": ds.retention_hours, **(upsert_limits or {})})
        kind, before, after = "upsert", stats.rows_before, stats.rows_after
        fields = _rewrite_fields(stats)
    if rejects:
        _keep_rejected(spark, rejected_table(table), rejected)
    src = seen.get
    return dict(load_kind=kind, qtty_before=before, qtty_source=src["rows"], qtty_after=after,
                null_keys=typed_seen.get["null_keys"], corrupt_lines=src["corrupt"],
                bad_values=sum(v for k, v in src.items() if k.startswith("bad_")),
                rows_quarantined=rejects, rows_dropped=src["rows"] - rejects - kept.get["rows"], **fields)


def _keep_rejected(spark: SparkSession, table: str, rejected: DataFrame) -> None:
    """Add rejected rows to their table; those of a file that is loaded again
    replace the ones it left there before."""
    if table_exists(spark, table):
        upsert_partitions(spark, table, rejected, ["file_name"])
    else:
        write_table(rejected, table, ["year_month_day"])


def _newer_than_table(target: DataFrame, source: DataFrame, ds: Dataset) -> DataFrame:
    """Source rows whose key has no row of a newer file date in the table."""
    # one row per key, also where a registered table holds a key twice
    newer = target.where(~null_key(ds.keys)).groupBy(*ds.keys).agg(F.max("year_month_day").alias("__day"))
    keyed = source.where(~null_key(ds.keys))
    stays = keyed.join(newer, list(ds.keys), "left").where(
        F.col("__day").isNull() | (F.col("year_month_day") >= F.col("__day")))
    return stays.select(*source.columns).unionByName(source.where(null_key(ds.keys)))


def raw_to_bronze(spark: SparkSession, ds: Dataset, landing_root: str, table: str,
                  start_date: str | None = None, final_date: str | None = None,
                  reprocess_all: bool = False, today: dt.date | None = None,
                  stage_typed: bool = True, upsert_limits: dict | None = None,
                  ledger: bool = False, log: str | None = None) -> DataFrame:
    """Stage 1. No table yet: first load from ``full-load/``; otherwise the
    files of ``cdc-load/`` in the window are upserted (S4, D13: last run
    wins, an older file loaded later overwrites newer rows).

    The caller passes the dates (D19); without them files of every date are
    read. The report counts the files outside the window and those without a
    date in their name. ``reprocess_all`` only widens the window to everything
    up to today (D15); ``rebuild_bronze`` builds the table anew.

    ``ledger`` loads the files of ``cdc-load/`` (in the window, if one is given)
    that have not been loaded yet, late ones too, and records them; a row of an
    older file then never replaces one of a newer file. ``log`` appends the
    report to a log folder.

    ``stage_typed`` (default) writes the typed rows once before the dedup:
    counts are exact under task retries and the CSV is parsed once. A first
    load of a long history may turn it off to write the data only once; the
    counts are then observed on the scan side, exact unless a map stage has
    to be run again after an executor loss. ``upsert_limits`` passes
    ``broadcast_rows`` / ``broadcast_bytes`` to the upsert. The staged data
    goes when the load has succeeded."""
    start, final = resolve_window(start_date, final_date, reprocess_all, today)
    exists = table_exists(spark, table)
    source = f"{landing_root.rstrip('/')}/{CDC_LOAD if exists else FULL_LOAD}"
    work = run_folder(spark, "bronze")
    by_ledger = ledger and exists
    new = None
    if by_ledger:
        book = f"{table_location(spark, table)}/{LEDGER}"
        new = stage(ledgers.unloaded(spark, book, list_files(spark, source, start, final)), f"{work}/files")
    scanned = _scan(spark, ds, source, start, final, new)
    counts = load_bronze(spark, ds, scanned, table, work, stage_typed, newest_wins=by_ledger,
                         upsert_limits=upsert_limits)
    if by_ledger:
        ledgers.record(spark, book, new)
    files = file_counts(spark, source, start, final)
    remove_folder(spark, work)
    report = run_report(spark, stage="bronze", start_date=start, final_date=final, source=source,
                        target=table, files_outside=files["files_outside"],
                        files_undated=files["files_undated"], **counts)
    if log:
        log_report(report, log)
    return report


# Folder of the file ledger, under the table's.
LEDGER = "_files"


def _scan(spark: SparkSession, ds: Dataset, source: str | list[str], start: str | None, final: str | None,
          files: DataFrame | None = None) -> DataFrame:
    """The landing rows of a window, or of a staged listing of files; columns
    by position, or by the header's names if the dataset says so."""
    paths = None if files is None else [r["path"] for r in files.select("path").collect()]
    schema = raw_schema(ds.raw_columns)
    if ds.bind_by_header:
        keys = [f.source for f in ds.bronze_mapping if f.target in ds.keys]
        return scan_by_header(spark, source, schema, start, final, ds.csv_options, keys, paths)
    if paths is not None:
        return scan_files(spark, paths, schema, ds.csv_options)
    return scan_dated(spark, source, schema, start, final, options=ds.csv_options)


def rebuild_bronze(spark: SparkSession, ds: Dataset, landing_root: str, table: str,
                   retention_hours: float = 168.0, today: dt.date | None = None,
                   log: str | None = None) -> DataFrame:
    """The table built anew from all files of both folders, beside the old
    one, and switched in one commit. The version before stays restorable
    (``publish.restore_version``) for ``retention_hours``. The latest file date
    wins, as in a load of all files at once."""
    start, final = resolve_window(None, None, True, today)
    root = landing_root.rstrip("/")
    sources = [f for f in (f"{root}/{FULL_LOAD}", f"{root}/{CDC_LOAD}") if path_exists(spark, f)]
    work = run_folder(spark, "rebuild")
    seen, typed_seen, kept = Observation("source"), Observation("typed"), Observation("kept")
    raw = _scan(spark, ds, sources, start, final).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("corrupt"), *cast_failures(ds.bronze_mapping))
    rejected, rejects = None, 0
    if ds.quarantine:
        typed, rejected = _split_rejected(raw, lambda df, keep: _conform_with(df, ds, keep), ds, f"{work}/typed", typed_seen)
        rejects = typed_seen.get["rejected"]
    else:
        typed = stage(conform(raw, ds), f"{work}/typed", observation=typed_seen, metrics=[_null_keys(ds)])
    before = sum(partition_rows(spark, table).values())
    replace_table(spark, table, latest_per_key(typed, ds.keys, ds.order_by), retention_hours,
                  observation=kept, metrics=[F.count(F.lit(1)).alias("rows")])
    if rejects:
        _keep_rejected(spark, rejected_table(table), rejected)
    remove_folder(spark, work)
    src, files = seen.get, file_counts(spark, sources, start, final)
    report = run_report(spark, stage="bronze", load_kind="rebuild", start_date=start, final_date=final, source=root,
                        target=table, qtty_before=before, qtty_source=src["rows"], qtty_after=kept.get["rows"],
                        null_keys=typed_seen.get["null_keys"], corrupt_lines=src["corrupt"],
                        bad_values=sum(v for k, v in src.items() if k.startswith("bad_")), rows_quarantined=rejects,
                        rows_dropped=src["rows"] - rejects - kept.get["rows"], files_outside=files["files_outside"],
                        files_undated=files["files_undated"])
    if log:
        log_report(report, log)
    return report


def earliest_day(spark: SparkSession, table: str) -> str | None:
    """Earliest ``YYYYMMDD`` of a day-partitioned table, from the catalog's
    partition list (no data file is opened); ``None`` when it is empty."""
    if partition_columns(spark, table) != ["year", "month", "day"]:
        row = spark.table(table).agg(F.min("year_month_day").alias("d")).first()
        return row["d"] if row else None
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    ymd = F.concat(*[F.regexp_extract("partition", f"{c}=([^/]*)", 1)
                     for c in ("year", "month", "day")])
    return parts.agg(F.min(ymd).alias("d")).first()["d"]


def days_from(spark: SparkSession, table: str, first: str) -> list[str]:
    """The ``YYYYMMDD`` days of a day-partitioned table from ``first`` on, from
    the catalog's partition list."""
    ymd = F.concat(*[F.regexp_extract("partition", f"{c}=([^/]*)", 1) for c in ("year", "month", "day")])
    rows = spark.sql(f"SHOW PARTITIONS {table}").select(ymd.alias("d")).where(F.col("d") >= first)
    return [r["d"] for r in rows.orderBy("d").collect()]


def bronze_to_gold(spark: SparkSession, ds: Dataset, source_table: str, target_table: str,
                   day: str | list[str] | None = None, initial: str = "all",
                   today: dt.date | None = None, log: str | None = None) -> DataFrame:
    """Stage 2. Existing gold: the bronze rows of ``day`` replace their keys
    (K6); ``day`` may be a list, to publish days that were missed (D18), or
    ``'all'``. First load: every bronze day, or with ``initial='first'`` the
    earliest one (D3). ``rows_unpublished`` of the report counts, over the
    days that this run did not read, the bronze rows that gold's partition of
    the day lacks (from the partitions' row counts)."""
    exists = table_exists(spark, target_table)
    bronze = spark.table(source_table)
    if exists and day != "all":
        days = [resolve_day(d, today) for d in day] if isinstance(day, list) \
            else [resolve_day(day, today)]
        run_day = days[0] if len(days) == 1 else ",".join(days)
        src = day_filter(bronze, days, ds.partitions)
    elif exists or initial == "all":
        run_day, src = None, bronze
    else:
        run_day = earliest_day(spark, source_table)
        src = day_filter(bronze, [run_day] if run_day else [], ds.partitions)
    # staged: the upsert reads its source several times, and the counts are
    # those of the rows it gets
    seen, kept = Observation("bronze"), Observation("gold")
    mapped = apply_mapping(src.observe(seen, F.count(F.lit(1)).alias("rows"), *cast_failures(ds.gold_mapping)),
                           ds.gold_mapping)
    metrics = [F.count(F.lit(1)).alias("rows"), _null_keys(ds)]
    work = run_folder(spark, "gold")
    if not exists:
        write_table(mapped, target_table, ds.partitions, observation=kept, metrics=metrics,
                    table_format=ds.table_format)
        n = kept.get["rows"]
        counts = dict(load_kind="first", qtty_before=0, qtty_after=n)
    else:
        staged = stage(mapped, f"{work}/source", rebalance_by=ds.partitions,
                       observation=kept, metrics=metrics)
        # bronze holds each non-NULL key once if this library wrote it; a
        # registered table may not, so the keys are made distinct here
        stats = upsert_table(spark, target_table, staged, ds.keys,
                             replay_by=["file_name"] if "file_name" in staged.columns else ds.partitions,
                             retention_hours=ds.retention_hours)
        counts = dict(load_kind="upsert", qtty_before=stats.rows_before, qtty_after=stats.rows_after,
                      **_rewrite_fields(stats))
    report = dict(qtty_source=kept.get["rows"], null_keys=kept.get["null_keys"], rows_dropped=0,
                  bad_values=sum(v for k, v in seen.get.items() if k.startswith("bad_")))
    remove_folder(spark, work)
    done = run_report(spark, stage="gold", start_date=run_day, final_date=run_day, source=source_table,
                      target=target_table, rows_unpublished=_unpublished(spark, source_table, target_table, run_day),
                      **report, **counts)
    if log:
        log_report(done, log)
    return done


def _unpublished(spark: SparkSession, bronze: str, gold: str, run_day: str | None) -> int:
    """Bronze rows of days not read that gold lacks, by the partitions' rows."""
    if run_day is None:
        return 0
    read = {tuple(split_day(d)) for d in run_day.split(",")}
    held = partition_rows(spark, gold)
    return sum(max(0, n - held.get(names, 0)) for names, n in partition_rows(spark, bronze).items() if names not in read)


def run_stages(spark: SparkSession, ds: Dataset, landing_root: str, bronze: str, gold: str,
               day: str | None = None, today: dt.date | None = None) -> DataFrame:
    """The chain of the two jobs for one day: bronze, then gold once bronze
    has returned (an exception in bronze stops the chain). ``day`` is the
    business day (``None`` / ``'cron'`` = yesterday); returns both reports."""
    iso = None if day in (None, "", "cron") else split_day(day)
    start = "-".join(iso) if iso else "cron"
    first = raw_to_bronze(spark, ds, landing_root, bronze, start, start, today=today)
    second = bronze_to_gold(spark, ds, bronze, gold, day or "cron", today=today)
    return first.unionByName(second)


__all__ = ["run_stages", "raw_to_bronze", "rebuild_bronze", "load_bronze", "rejected_table", "bronze_to_gold", "earliest_day", "days_from", "conform",
           "FULL_LOAD", "CDC_LOAD", "split_day"]
