"""Driver queries for what happens to a table after its first load: versions,
types, writers side by side, retention, bad rows, late files, rebuilds, the log.

Each takes the given tables, changes a table made of them the way a user would,
and returns rows that DuckDB computes from the tables alone (``ORACLE``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.operators.dedup import latest_per_key
from daylake.operators.upsert import merge_on_condition
from daylake.plans import manifest
from daylake.plans.datasets import EVENTS
from daylake.plans.jobs import CDC_LOAD, FULL_LOAD, bronze_to_gold, raw_to_bronze, rebuild_bronze, rejected_table
from daylake.plans.landed import write_dated_csv
from daylake.plans.publish import (apply_upsert, index_keys, plan_upsert, read_version, register_external, remove_orphans,
                                   restore_version, stage, table_location, truncate, upsert_partitions, write_table)
from daylake.plans.queries import (BAD_KEY_EVERY, CHEAP, LANDING_SPLIT, LINEITEM_KEYS, LINEITEM_SOURCE_FROM,
                                   LINEITEM_TARGET_BEFORE, TS_FORMAT, _events_out, _lake, _land, _read, landing)
from daylake.plans.report import read_log
from daylake.session import run_folder
from daylake.sources.tables import read_snapshot
from daylake.streaming import stream_to_bronze

LATE_EVERY = 3          # of the change days, every third arrives late
RARE_KEYS = 5           # keys of the source that asks the key index
SWAPPED_EVERY = 2       # every second day is landed with another column order


def _year_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.date_format("o_orderdate", "yyyy").alias("o_year"))


def _orders_table(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, DataFrame]:
    db, _ = _lake(spark, label)
    table = f"{db}.orders"
    orders = _year_orders(spark, sf_dir)
    write_table(orders, table, ["o_year"])
    return table, orders


def _changed(orders: DataFrame, where, status: str) -> DataFrame:
    return stage(orders.where(where).withColumn("o_orderstatus", F.lit(status)),
                 f"{run_folder(orders.sparkSession, 'changed')}/source")


def q_merge_on_condition(spark, sf_dir):
    """The upsert as a full join of ``target`` and ``delta`` on the merge
    condition of a composite key."""
    rows = _read(spark, sf_dir, "lineitem")
    old, new = (latest_per_key(rows.where(w), LINEITEM_KEYS, ["l_shipdate desc"])
                for w in (F.col("l_shipdate") < F.lit(LINEITEM_TARGET_BEFORE), F.col("l_shipdate") >= F.lit(LINEITEM_SOURCE_FROM)))
    return merge_on_condition(old, new, LINEITEM_KEYS).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def q_snapshot_after_upsert(spark, sf_dir):
    """After an upsert the catalog, a read by path and a
    registration over the folder give the same rows."""
    table, orders = _orders_table(spark, sf_dir, "snapshot")
    upsert_partitions(spark, table, _changed(orders, F.col("o_totalprice") < CHEAP, "Z"), ["o_orderkey"])
    # cheap orders of later years move to the first one: partitions are rewritten, and left by rows
    moved = stage(orders.where(F.col("o_totalprice") < CHEAP / 4).withColumns(
        {"o_year": F.lit("1990"), "o_orderstatus": F.lit("Y")}), f"{run_folder(spark, 'moved')}/source")
    upsert_partitions(spark, table, moved, ["o_orderkey"])
    root = table_location(spark, table)
    registered = f"{table}_again"
    register_external(spark, registered, None, root)

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("o_year", "o_orderstatus").agg(
            F.count(F.lit(1)).alias(f"{name}_rows"), F.sum("o_orderkey").alias(f"{name}_keys"))

    return (counted(spark.table(table), "catalog")
            .join(counted(read_snapshot(spark, root), "path"), ["o_year", "o_orderstatus"], "full")
            .join(counted(spark.table(registered), "registered"), ["o_year", "o_orderstatus"], "full"))


def q_publish_wider_type(spark, sf_dir):
    """K4: int to bigint (read in place), date to timestamp (old rows rewritten),
    and a narrower source cast to the table's type; text for a number is refused
    before anything is written."""
    db, _ = _lake(spark, "wider")
    table = f"{db}.orders"
    orders = _year_orders(spark, sf_dir)
    first = orders.withColumn("o_custkey", F.col("o_custkey").cast("int"))
    write_table(first, table, ["o_year"])
    cheap = F.col("o_totalprice") < CHEAP
    wide = orders.where(cheap).withColumns({"o_custkey": F.col("o_custkey") + F.lit(3_000_000_000),
                                            "o_orderstatus": F.lit("W")})
    upsert_partitions(spark, table, stage(wide, f"{run_folder(spark, 'wide')}/source"), ["o_orderkey"])
    times = orders.where(~cheap & (F.col("o_custkey") % 2 == 0)).withColumns(
        {"o_orderdate": F.col("o_orderdate").cast("timestamp") + F.expr("interval 90 minutes"),
         "o_custkey": F.col("o_custkey").cast("int")})
    upsert_partitions(spark, table, stage(times, f"{run_folder(spark, 'times')}/source"), ["o_orderkey"])
    version = manifest.latest(spark, table_location(spark, table)).version
    try:
        upsert_partitions(spark, table, orders.withColumn("o_custkey", F.lit("x")), ["o_orderkey"])
        raise RuntimeError("text was written into a number")
    except ValueError:
        pass
    if manifest.latest(spark, table_location(spark, table)).version != version:
        raise RuntimeError("a refused upsert has changed the table")
    return spark.table(table).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_year",
                                     F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))


def q_upsert_two_writers(spark, sf_dir):
    """K2, K6: two upserts planned on one version; the second to commit plans
    again, and a reader that holds the first version still sees all of it."""
    table, orders = _orders_table(spark, sf_dir, "writers")
    upsert_partitions(spark, table, _changed(orders, F.col("o_orderkey") % 7 == 0, "A"), ["o_orderkey"],
                      retention_hours=1.0)
    reader = read_version(spark, table)
    slow = _changed(orders, F.col("o_totalprice") < CHEAP, "S")
    fast = _changed(orders, F.col("o_totalprice") > 2 * CHEAP, "F")
    stale = plan_upsert(spark, table, slow, ["o_orderkey"])
    upsert_partitions(spark, table, fast, ["o_orderkey"], retention_hours=1.0)
    try:
        apply_upsert(spark, stale, retention_hours=1.0)
        raise RuntimeError("the second commit on one version went through")
    except manifest.CommitConflict:
        upsert_partitions(spark, table, slow, ["o_orderkey"], retention_hours=1.0)
    seen = reader.select("o_orderkey", F.col("o_orderstatus").alias("status_read_before"))
    return spark.table(table).select("o_orderkey", "o_orderstatus", "o_year").join(seen, "o_orderkey", "full")


def q_upsert_key_index(spark, sf_dir):
    """With a key index the statistics pass reads only partitions that
    may hold the source's keys; the rows are those of the full scan."""
    db, _ = _lake(spark, "index")
    orders = _year_orders(spark, sf_dir)
    table, plain = f"{db}.orders", f"{db}.orders_plain"
    rare = orders.orderBy("o_orderkey").limit(RARE_KEYS).withColumn("o_orderstatus", F.lit("R"))
    source = stage(rare, f"{run_folder(spark, 'rare')}/source")
    for name in (table, plain):
        write_table(orders, name, ["o_year"])
    index_keys(spark, table, ["o_orderkey"])
    # the second upsert relies on the index rows of partitions the first has written
    for status in ("Q", "R"):
        change = stage(source.withColumn("o_orderstatus", F.lit(status)), f"{run_folder(spark, 'rare')}/source")
        by_index = upsert_partitions(spark, table, change, ["o_orderkey"], source_unique=True)
    by_scan = upsert_partitions(spark, plain, source, ["o_orderkey"], source_unique=True)
    if by_index.partitions_read is None or by_index.partitions_read > RARE_KEYS:
        raise RuntimeError(f"the index left {by_index.partitions_read} partitions to read")
    if (by_index.rows_matched, by_index.rows_after) != (by_scan.rows_matched, by_scan.rows_after):
        raise RuntimeError("the index gave other counts than the scan")
    return spark.table(table).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_year")


def q_remove_orphans(spark, sf_dir):
    """K5 retention: a run that died before its commit leaves files; they are in
    no read, and the removal takes them and nothing else."""
    table, orders = _orders_table(spark, sf_dir, "orphans")
    upsert_partitions(spark, table, _changed(orders, F.col("o_totalprice") < CHEAP, "Z"), ["o_orderkey"])
    root = table_location(spark, table)
    dead = f"{root}/{manifest.RUN}={uuid.uuid4().hex[:12]}"
    orders.where(F.col("o_totalprice") > 2 * CHEAP).write.partitionBy("o_year").parquet(dead)
    left = orders.where(F.col("o_totalprice") > 2 * CHEAP).select("o_year").distinct().count()
    young = remove_orphans(spark, table, older_than_hours=24.0)
    gone = remove_orphans(spark, table, older_than_hours=0.0)
    if young or len(gone) != left or remove_orphans(spark, table, older_than_hours=0.0):
        raise RuntimeError(f"removed {len(young)} and {len(gone)} folders of {left}")
    return read_snapshot(spark, root).select("o_orderkey", "o_orderstatus", "o_year")


def q_truncate_restore(spark, sf_dir):
    """A truncated partitioned table is empty by name and by path, and
    restorable within its retention."""
    table, orders = _orders_table(spark, sf_dir, "restore")
    upsert_partitions(spark, table, _changed(orders, F.col("o_totalprice") < CHEAP, "Z"), ["o_orderkey"])
    root = table_location(spark, table)
    version = manifest.latest(spark, root).version
    truncate(spark, table, retention_hours=1.0)
    empty = (spark.table(table).count(), read_snapshot(spark, root).count())
    restore_version(spark, table, version)
    return spark.table(table).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "o_orderstatus", "n_rows", F.lit(empty[0]).alias("rows_by_name"), F.lit(empty[1]).alias("rows_by_path"))


def _bad_key(column: str = "user_id"):
    """Every ``BAD_KEY_EVERY``-th event has a key that is no number, the one
    after it none at all."""
    return (F.when(F.col("event_id") % BAD_KEY_EVERY == 0, F.lit("x"))
            .when(F.col("event_id") % BAD_KEY_EVERY == 1, F.lit(None).cast("string"))
            .otherwise(F.col(column).cast("string")))


def q_quarantine(spark, sf_dir):
    """Bad rows go to the table's side table, with file, column and
    value, in the same scan; the good ones are loaded. Both loads, replayed once."""
    db, _ = _lake(spark, "quarantine")
    table = f"{db}.events"
    root = _land(spark, sf_dir, "landing-bad", _bad_key())
    careful = replace(EVENTS, quarantine=True)
    for _ in range(3):
        raw_to_bronze(spark, careful, root, table)
    good = spark.table(table).select(
        F.lit("loaded").alias("kind"), F.col("user_id").cast("string").alias("key"), "year_month_day",
        F.lit(None).cast("string").alias("bad_column"), F.lit(None).cast("string").alias("bad_value"),
        F.lit(True).alias("file_matches"))
    one = F.col("problems")[0]
    bad = spark.table(rejected_table(table)).select(
        one["reason"].alias("kind"), F.get_json_object("line", "$.event_id").alias("key"), "year_month_day",
        one["column"].alias("bad_column"), one["value"].alias("bad_value"),
        F.col("file_name").endswith(F.concat("year_month_day", F.lit(".csv"))).alias("file_matches"))
    return good.unionByName(bad)


def q_quarantine_counts(spark, sf_dir):
    """Rows in = loaded + dropped as older + quarantined, per load."""
    db, _ = _lake(spark, "quarantine")
    root = _land(spark, sf_dir, "landing-bad", _bad_key())
    careful = replace(EVENTS, quarantine=True)
    reports = [raw_to_bronze(spark, careful, root, f"{db}.events") for _ in range(2)]
    return reports[0].unionByName(reports[1]).select(
        "load_kind", "qtty_source", "rows_quarantined", "rows_dropped",
        (F.col("qtty_source") - F.col("rows_quarantined") - F.col("rows_dropped")).alias("rows_loaded"))


def q_header_binding(spark, sf_dir):
    """Files whose header has another column order, one more column or
    other capitals load right beside the plain ones."""
    root = run_folder(spark, "landing-headers")
    ev = _read(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    rows = ev.select("event_id", F.date_format("ts", TS_FORMAT).alias("ts"), "user_id", "event_type", "value", "props",
                     day.alias("__day"), F.lit(FULL_LOAD).alias("__folder"))
    odd = F.dayofmonth(F.to_date("__day", "yyyyMMdd")) % SWAPPED_EVERY == 1
    write_dated_csv(rows.where(~odd), root, "__day", "__folder", prefix="plain")
    swapped = rows.where(odd).select("props", F.col("value").alias("VALUE"), "user_id", F.lit("?").alias("note"), "ts",
                                     "event_type", F.col("event_id").alias("Event_Id"), "__day", "__folder")
    write_dated_csv(swapped, root, "__day", "__folder", prefix="swapped")
    db, _ = _lake(spark, "headers")
    raw_to_bronze(spark, replace(EVENTS, bind_by_header=True), root, f"{db}.events")
    return _events_out(spark.table(f"{db}.events"))


def _late(day):
    return F.dayofmonth(F.to_date(day, "yyyyMMdd")) % LATE_EVERY == 0


def q_late_files(spark, sf_dir):
    """Files that arrive after later days have been loaded are loaded by the
    next run, without a date window; another run finds nothing."""
    db, _ = _lake(spark, "late")
    table, root = f"{db}.events", run_folder(spark, "landing-late")
    ev = _read(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    rows = ev.select("event_id", F.date_format("ts", TS_FORMAT).alias("ts"), "user_id", "event_type", "value", "props",
                     day.alias("__day"), F.when(day < F.lit(LANDING_SPLIT), F.lit(FULL_LOAD))
                     .otherwise(F.lit(CDC_LOAD)).alias("__folder"))
    late = (F.col("__folder") == CDC_LOAD) & _late("__day")
    write_dated_csv(rows.where(~late), root, "__day", "__folder", prefix="events")
    raw_to_bronze(spark, EVENTS, root, table)
    first = raw_to_bronze(spark, EVENTS, root, table, ledger=True)
    write_dated_csv(rows.where(late), root, "__day", "__folder", prefix="events")
    second = raw_to_bronze(spark, EVENTS, root, table, ledger=True)
    third = raw_to_bronze(spark, EVENTS, root, table, ledger=True)
    loads = [first, second, third]
    counts = [r.first()["qtty_source"] for r in loads]
    return _events_out(spark.table(table)).withColumns(
        {f"load_{k}": F.lit(n).cast("long") for k, n in enumerate(counts, 1)})


def q_reprocess_all(spark, sf_dir):
    """A table in a wrong state is rebuilt from all files beside itself and
    switched at once; the rebuilt rows equal a clean load, and the version
    before can be restored and switched forward again."""
    db, _ = _lake(spark, "rebuild")
    table, root = f"{db}.events", landing(spark, sf_dir)
    raw_to_bronze(spark, EVENTS, root, table)
    wrong = spark.table(table).where("user_id % 3 = 0").withColumn("value", F.lit(-1.0))
    upsert_partitions(spark, table, stage(wrong, f"{run_folder(spark, 'wrong')}/source"), EVENTS.keys)
    folder = table_location(spark, table)
    before = manifest.latest(spark, folder).version
    held = spark.table(table).count()
    rebuild_bronze(spark, EVENTS, root, table, today=dt.date(2100, 1, 1))
    rebuilt = manifest.latest(spark, folder).version
    restore_version(spark, table, before)
    again = spark.table(table).agg(F.count(F.lit(1)), F.count(F.when(F.col("value") == -1, 1))).first()
    if again[0] != held or again[1] == 0:
        raise RuntimeError("the version before the rebuild was not restored")
    restore_version(spark, table, rebuilt)
    return _events_out(spark.table(table))


def q_run_log(spark, sf_dir):
    """One log for batch and stream; loading the same change files (one of
    them without a date in its name), both write the same counts."""
    db, location = _lake(spark, "log")
    log, root = f"{location}/run_log", run_folder(spark, "landing-log")
    ev = _read(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    rows = ev.select("event_id", F.date_format("ts", TS_FORMAT).alias("ts"), _bad_key().alias("user_id"), "event_type",
                     "value", "props", day.alias("__day"),
                     F.when(day < F.lit(LANDING_SPLIT), F.lit(FULL_LOAD)).otherwise(F.lit(CDC_LOAD)).alias("__folder"))
    write_dated_csv(rows, root, "__day", "__folder", prefix="events")
    undated = rows.where(F.col("event_id") % 5 == 0).withColumns({"__day": F.lit("undated"), "__folder": F.lit(CDC_LOAD)})
    write_dated_csv(undated, root, "__day", "__folder", prefix="events")
    for name in ("batch", "stream"):
        raw_to_bronze(spark, EVENTS, root, f"{db}.{name}", log=log)
    raw_to_bronze(spark, EVENTS, root, f"{db}.batch", log=log)
    query = stream_to_bronze(spark, EVENTS, root, f"{db}.stream", f"{location}/_checkpoint_log", log=log)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    bronze_to_gold(spark, EVENTS, f"{db}.stream", f"{db}.gold", log=log)
    return read_log(spark, log).select("stage", "load_kind", "qtty_before", "qtty_source", "qtty_after", "null_keys",
                                       "bad_values", "corrupt_lines", "rows_dropped",
                                       (F.coalesce("files_undated", F.lit(0)) > 0).alias("has_undated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "merge_on_condition": q_merge_on_condition,
    "snapshot_after_upsert": q_snapshot_after_upsert,
    "publish_wider_type": q_publish_wider_type,
    "upsert_two_writers": q_upsert_two_writers,
    "upsert_key_index": q_upsert_key_index,
    "remove_orphans": q_remove_orphans,
    "truncate_restore": q_truncate_restore,
    "quarantine": q_quarantine,
    "quarantine_counts": q_quarantine_counts,
    "header_binding": q_header_binding,
    "late_files": q_late_files,
    "reprocess_all": q_reprocess_all,
    "run_log": q_run_log,
}
