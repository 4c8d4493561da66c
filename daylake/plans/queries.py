"""Driver queries over the given tables, each with its DuckDB oracle.

The driver's ``events`` table stands in for the policy change files: its
rows are landed as dated CSV files (``full-load/`` before ``LANDING_SPLIT``,
``cdc-load/`` from it on), and the jobs run on those files exactly as
they would on policy files. Other queries use ``orders``, ``lineitem``,
``customer`` and ``nation`` where a composite key, a catalog table or a
typed mapping is wanted. Timestamps leave as formatted strings and dates as
dates so that both engines give the same values.
"""

from __future__ import annotations

import threading
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.functions.mapping import Field, apply_mapping, cast_failures, raw_schema
from daylake.functions.naming import snake_case_columns
from daylake.operators.aggregate import aggregate_by_name
from daylake.operators.dedup import latest_per_key
from daylake.operators.filters import day_filter
from daylake.operators.upsert import merge_by_key, replace_by_key, union_by_name, unmatched
from daylake.plans.datasets import EVENTS
from daylake.plans.jobs import (CDC_LOAD, FULL_LOAD, bronze_to_gold, conform, days_from,
                                     earliest_day, raw_to_bronze, run_stages)
from daylake.plans.landed import write_dated_csv
from daylake.plans.publish import (apply_upsert, create_database, plan_upsert, register_external,
                                   stage, truncate, upsert_partitions, write_table)
from daylake.session import conf_override, run_folder, workspace
from daylake.sources.landing import scan_dated
from daylake.sources.tables import (is_nonempty, path_exists, read_snapshot,
                                    table_exists)

# Parameters of the driver queries (days are file-name dates).
LANDING_SPLIT = "20240120"      # full-load/ holds days before it, cdc-load/ the rest
WINDOW = ("2024-01-10", "2024-01-15")
ONE_DAY = "20240115"
GOLD_DAYS = ["20240128", "20240129", "20240130"]   # published together (D18)
REPLACE_UNTIL = "20240124"      # rows of later days replace those of earlier ones
BAD_KEY_EVERY = 97              # in the probe landing, events whose key is malformed
CHEAP = 150000                  # orders below it are updated
PRICE_LIMIT = 400000
ORDERS_CUTOFF = "1998-01-01"
LINEITEM_TARGET_BEFORE = "2000-01-01"
LINEITEM_SOURCE_FROM = "1999-01-01"

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

_lock = threading.RLock()
_memo: dict[tuple, object] = {}


def _app(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # no JVM-side context (Spark Connect)
        return str(id(spark))


def _memoized(key: tuple, build: Callable[[], object],
              valid: Callable[[object], bool] = lambda _: True):
    """Build once per key; rebuild if ``valid`` says the cached value is gone
    (e.g. a table of a catalog that was stopped with its session)."""
    with _lock:
        if key not in _memo or not valid(_memo[key]):
            _memo[key] = build()
        return _memo[key]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _land(spark: SparkSession, sf_dir: str, label: str, user) -> str:
    root = run_folder(spark, label)
    ev = _read(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    rows = ev.select(
        "event_id", F.date_format("ts", TS_FORMAT).alias("ts"), user.alias("user_id"),
        "event_type", "value", "props", day.alias("__day"),
        F.when(day < F.lit(LANDING_SPLIT), F.lit(FULL_LOAD))
         .otherwise(F.lit(CDC_LOAD)).alias("__folder"))
    write_dated_csv(rows, root, "__day", "__folder", prefix="events") \
        .agg(F.sum("rows")).collect()
    return root


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Land ``events`` as dated CSV files once per process and workspace."""
    return _memoized(("landing", workspace(spark), sf_dir),
                     lambda: _land(spark, sf_dir, "landing", F.col("user_id")),
                     lambda root: path_exists(spark, f"{root}/{FULL_LOAD}"))


def _events_scan(spark, sf_dir, folders=(FULL_LOAD, CDC_LOAD), start=None, final=None):
    root = landing(spark, sf_dir)
    return scan_dated(spark, [f"{root}/{f}" for f in folders],
                      raw_schema(EVENTS.raw_columns), start, final, options=EVENTS.csv_options)


def _events_out(df: DataFrame, props: bool = True, ymd: bool = True,
                parts: bool = False) -> DataFrame:
    cols = [F.col("event_id"), F.date_format("ts", TS_FORMAT).alias("ts"),
            F.col("user_id"), F.col("event_type"), F.col("value")]
    if props:
        cols.append(F.col("props"))
    if ymd:
        cols.append(F.col("year_month_day"))
    if parts:
        cols += [F.col("year"), F.col("month"), F.col("day")]
    return df.select(*cols)


def _lake(spark: SparkSession, label: str) -> tuple[str, str]:
    """A new database (K7) under the workspace: returns (name, location)."""
    name = _unique(f"daylake_{label}")
    location = f"{workspace(spark)}/daylake/lake/{name}"
    create_database(spark, name, location, comment=f"daylake {label} tables",
                    properties={"owner": "daylake", "description": "driver queries"})
    return name, location


def _events_by_day(spark: SparkSession, sf_dir: str) -> str:
    """All landed events, typed, as a table partitioned by day (K1)."""
    def build():
        db, _ = _lake(spark, "days")
        table = f"{db}.events_by_day"
        write_table(conform(_events_scan(spark, sf_dir), EVENTS), table, EVENTS.partitions)
        return table
    return _memoized(("by_day", _app(spark), workspace(spark), sf_dir), build,
                     lambda table: table_exists(spark, table))


def _bronze_runs(spark: SparkSession, sf_dir: str):
    """Bronze job twice: first load from full-load/, upsert from cdc-load/."""
    def build():
        db, _ = _lake(spark, "bronze")
        table = f"{db}.events"
        root = landing(spark, sf_dir)
        first = raw_to_bronze(spark, EVENTS, root, table)
        second = raw_to_bronze(spark, EVENTS, root, table)
        return table, first.unionByName(second)
    return _memoized(("bronze", _app(spark), workspace(spark), sf_dir), build,
                     lambda value: table_exists(spark, value[0]))


# --------------------------------------------------------------- queries

def q_csv_scan_typed(spark, sf_dir):
    return _events_out(conform(_events_scan(spark, sf_dir), EVENTS), ymd=False)


def q_landing_date_window(spark, sf_dir):
    rows = _events_scan(spark, sf_dir, (FULL_LOAD,), *WINDOW)
    return rows.groupBy("year_month_day").agg(F.count(F.lit(1)).alias("n_rows"))


CUSTOMER_PROBE = [
    Field("c_custkey", "c_custkey", "bigint"),
    Field("c_name", "name_as_bigint", "bigint"),
    Field("c_nationkey", "c_nationkey", "int"),
    Field("c_acctbal", "c_acctbal", "double"),
    Field("c_acctbal", "acctbal_as_bigint", "bigint"),
    Field("c_mktsegment", "segment_as_date", "date"),
    Field("c_mktsegment", "c_mktsegment", "string"),
]


def _customer_text(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    return c.select(*[F.col(n).cast("string").alias(n) for n in c.columns])


def q_typed_mapping_bad_values(spark, sf_dir):
    return apply_mapping(_customer_text(spark, sf_dir), CUSTOMER_PROBE)


def q_cast_failure_counts(spark, sf_dir):
    return _customer_text(spark, sf_dir).agg(*cast_failures(CUSTOMER_PROBE))


def q_lineage_date_parts(spark, sf_dir):
    df = conform(_events_scan(spark, sf_dir), EVENTS)
    return df.select(
        "event_id", "year_month_day", "year", "month", "day",
        F.col("file_name").endswith(F.concat("year_month_day", F.lit(".csv")))
         .alias("name_matches"))


ORDERS_GOLD = [
    Field("o_orderkey", "order_id", "bigint"),
    Field("o_custkey", "customer_id", "bigint"),
    Field("o_orderstatus", "status", "string"),
    Field("o_totalprice", "total_price", "double"),
    Field("o_orderdate", "order_date", "date"),
]


def q_gold_projection(spark, sf_dir):
    return apply_mapping(_read(spark, sf_dir, "orders"), ORDERS_GOLD)


def q_snake_case_columns(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    camel = o.select(F.col("o_orderkey").alias("OrderKey"),
                     F.col("o_custkey").alias("CustomerID"),
                     F.col("o_orderstatus").alias("OrderStatus"),
                     F.col("o_totalprice").alias("Total-Price"),
                     F.col("o_orderdate").cast("date").alias("OrderDate"),
                     F.col("o_orderpriority").alias("HTMLOrderPriority"))
    return snake_case_columns(camel)


def q_latest_per_key(spark, sf_dir):
    typed = conform(_events_scan(spark, sf_dir), EVENTS)
    return _events_out(latest_per_key(typed, EVENTS.keys, EVENTS.order_by))


LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]


def _lineitem_out(df):
    return df.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def q_latest_per_composite_key(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    return _lineitem_out(latest_per_key(li, LINEITEM_KEYS, ["l_shipdate desc"]))


def q_partition_day_filter(spark, sf_dir):
    table = _events_by_day(spark, sf_dir)
    return _events_out(day_filter(spark.table(table), [ONE_DAY]))


def q_first_day_rows(spark, sf_dir):
    table = _events_by_day(spark, sf_dir)
    first = earliest_day(spark, table)
    return _events_out(day_filter(spark.table(table), [first] if first else []))


def q_first_day_rows_join(spark, sf_dir):
    """J1 on a plain DataFrame (no partitions): join with the one-row min."""
    from daylake.operators.aggregate import rows_at_earliest
    return _events_out(rows_at_earliest(conform(_events_scan(spark, sf_dir), EVENTS),
                                        "year_month_day"))


ORDER_AGGS = [("o_totalprice", "sum"), ("o_totalprice", "avg"),
              ("o_totalprice", "min"), ("o_totalprice", "max"),
              ("o_totalprice", "stddev_pop"), ("o_totalprice", "stddev_samp"),
              ("o_orderkey", "count"), ("o_custkey", "countDistinct")]


def _rounded(df):
    return df.withColumns({f"{f}_o_totalprice": F.round(f"{f}_o_totalprice", 2)
                           for f in ("sum", "avg", "stddev_pop", "stddev_samp")})


def q_agg_by_name_global(spark, sf_dir):
    return _rounded(aggregate_by_name(_read(spark, sf_dir, "orders"), [], ORDER_AGGS))


def q_agg_by_name_grouped(spark, sf_dir):
    return _rounded(aggregate_by_name(_read(spark, sf_dir, "orders"),
                                      ["o_orderstatus", "o_orderpriority"], ORDER_AGGS))


def q_merge_upsert(spark, sf_dir):
    target = latest_per_key(conform(_events_scan(spark, sf_dir, (FULL_LOAD,)), EVENTS),
                            EVENTS.keys, EVENTS.order_by)
    source = latest_per_key(conform(_events_scan(spark, sf_dir, (CDC_LOAD,)), EVENTS),
                            EVENTS.keys, EVENTS.order_by)
    return _events_out(merge_by_key(target, source, EVENTS.keys))


def q_merge_upsert_composite(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    target = latest_per_key(li.where(F.col("l_shipdate") < F.lit(LINEITEM_TARGET_BEFORE)),
                            LINEITEM_KEYS, ["l_shipdate desc"])
    source = latest_per_key(li.where(F.col("l_shipdate") >= F.lit(LINEITEM_SOURCE_FROM)),
                            LINEITEM_KEYS, ["l_shipdate desc"])
    return _lineitem_out(merge_by_key(target, source, LINEITEM_KEYS))


def q_unmatched_rows(spark, sf_dir):
    customer = _read(spark, sf_dir, "customer")
    big = (_read(spark, sf_dir, "orders").where(F.col("o_totalprice") > PRICE_LIMIT)
           .select(F.col("o_custkey").alias("c_custkey")))
    return unmatched(customer, big, ["c_custkey"])


def q_replace_by_key(spark, sf_dir):
    scan_all = conform(_events_scan(spark, sf_dir), EVENTS)
    bronze = latest_per_key(scan_all, EVENTS.keys, EVENTS.order_by)
    old = latest_per_key(conform(_events_scan(spark, sf_dir, final=REPLACE_UNTIL), EVENTS),
                         EVENTS.keys, EVENTS.order_by)
    target = apply_mapping(old, EVENTS.gold_mapping)
    source = apply_mapping(bronze.where(F.col("year_month_day") > REPLACE_UNTIL), EVENTS.gold_mapping)
    return _events_out(replace_by_key(target, source, EVENTS.keys), props=False)


def _orders_out(df):
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     F.col("o_orderdate").cast("date").alias("o_orderdate"),
                     "o_orderpriority")


def q_union_all_by_name(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(ORDERS_CUTOFF)
    older = o.where(early)
    newer = o.where(~early | F.col("o_orderdate").isNull()).select(*reversed(o.columns))
    return _orders_out(union_by_name(older, newer))


SNAPSHOT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                   "value double, props string, file_name string, year_month_day string, "
                   "year string, month string, day string")


def q_partitioned_write_roundtrip(spark, sf_dir):
    path = f"{run_folder(spark, 'snapshot')}/events"
    (conform(_events_scan(spark, sf_dir), EVENTS).write.mode("overwrite")
        .option("compression", "snappy").partitionBy(*EVENTS.partitions).parquet(path))
    snap = read_snapshot(spark, path, SNAPSHOT_SCHEMA)
    return snap.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string, "
              "o_year string")


def q_catalog_register_read(spark, sf_dir):
    db, location = _lake(spark, "catalog")
    path = f"{location}/orders_files"
    (_read(spark, sf_dir, "orders").withColumn("o_year", F.date_format("o_orderdate", "yyyy"))
        .write.mode("overwrite").partitionBy("o_year").parquet(path))
    table = f"{db}.orders"
    register_external(spark, table, ORDERS_DDL, path, ["o_year"])
    if not table_exists(spark, table):
        raise RuntimeError(f"{table} was not registered")
    return _orders_out(spark.table(table))


def _table_location(spark, table):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def q_table_exists_nonempty(spark, sf_dir):
    db, _ = _lake(spark, "flags")
    table = f"{db}.nation"
    write_table(_read(spark, sf_dir, "nation"), table, [])
    t = spark.table(table)
    flags = (path_exists(spark, _table_location(spark, table)),
             table_exists(spark, table), is_nonempty(t),
             table_exists(spark, f"{db}.missing"), is_nonempty(t.where(F.lit(False))))
    return t.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(flags[0]).alias("path_exists"), F.lit(flags[1]).alias("table_exists"),
        F.lit(flags[2]).alias("nonempty"), F.lit(flags[3]).alias("missing_exists"),
        F.lit(flags[4]).alias("empty_nonempty"), "n_rows")


def q_truncate_table(spark, sf_dir):
    db, _ = _lake(spark, "trunc")
    table = f"{db}.nation"
    write_table(_read(spark, sf_dir, "nation"), table, [])
    before = spark.table(table).count()
    truncate(spark, table)
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows_after")) \
        .select(F.lit(before).cast("long").alias("rows_before"), "rows_after")


def q_load_source_switch(spark, sf_dir):
    table, _ = _bronze_runs(spark, sf_dir)
    return _events_out(spark.table(table))


def q_gold_days_list(spark, sf_dir):
    """Gold first load (earliest bronze day), then one run that publishes a
    list of days at once (D18). Reads the bronze table of ``_bronze_runs``."""
    bronze, _ = _bronze_runs(spark, sf_dir)
    db, _ = _lake(spark, "gold_days")
    gold = f"{db}.events"
    bronze_to_gold(spark, EVENTS, bronze, gold, initial="first")
    bronze_to_gold(spark, EVENTS, bronze, gold, day=list(GOLD_DAYS))
    return _events_out(spark.table(gold), props=False, parts=True)


def q_gold_initial_all(spark, sf_dir):
    """Gold first load of every bronze day (the D3 option ``initial='all'``)."""
    bronze, _ = _bronze_runs(spark, sf_dir)
    db, _ = _lake(spark, "gold_all")
    gold = f"{db}.events"
    bronze_to_gold(spark, EVENTS, bronze, gold, initial="all")
    return _events_out(spark.table(gold), props=False, parts=True)


def q_upsert_shuffle_join(spark, sf_dir):
    """The bronze upsert without any broadcast: the sort-merge path that a
    source with too many keys takes, checked on the plan."""
    db, _ = _lake(spark, "smj")
    table = f"{db}.events"
    raw_to_bronze(spark, EVENTS, landing(spark, sf_dir), table)
    source = latest_per_key(conform(_events_scan(spark, sf_dir, (CDC_LOAD,)), EVENTS), EVENTS.keys, EVENTS.order_by)
    source = stage(source, f"{run_folder(spark, 'smj')}/source", rebalance_by=EVENTS.partitions)
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_upsert(spark, table, source, EVENTS.keys, broadcast_rows=0, source_unique=True)
        if "SortMergeJoin" not in plan.rewrite._jdf.queryExecution().executedPlan().toString():
            raise RuntimeError("expected the sort-merge path")
        apply_upsert(spark, plan)
    return _events_out(spark.table(table))


def q_run_report(spark, sf_dir):
    """Reports of both jobs over files in which some keys are malformed."""
    db, _ = _lake(spark, "report")
    bronze, gold = f"{db}.events", f"{db}.events_gold"
    bad = F.when(F.col("event_id") % BAD_KEY_EVERY == 0, F.lit("x")).otherwise(F.col("user_id").cast("string"))
    root = _land(spark, sf_dir, "landing-probe", bad)
    first = raw_to_bronze(spark, EVENTS, root, bronze)
    second = raw_to_bronze(spark, EVENTS, root, bronze)
    reports = first.unionByName(second).unionByName(bronze_to_gold(spark, EVENTS, bronze, gold))
    return reports.select("stage", "load_kind", "qtty_before", "qtty_source", "qtty_after",
                          "null_keys", "bad_values", "rows_dropped")


ORDER_PARTS = ["priority", "dear", "share"]


def _order_parts(df):
    return df.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderpriority").alias("priority"),
        (F.col("o_totalprice") > PRICE_LIMIT / 2).alias("dear"), (F.col("o_custkey") % 8 / 4).alias("share"))


def q_upsert_typed_partitions(spark, sf_dir):
    """Upsert that touches more than 32 partitions of string, boolean and
    double columns (K2)."""
    db, _ = _lake(spark, "typed")
    table = f"{db}.orders"
    orders = _order_parts(_read(spark, sf_dir, "orders"))
    write_table(orders, table, ORDER_PARTS)
    source = stage(orders.where(F.col("o_totalprice") < CHEAP).withColumn("o_orderstatus", F.lit("Z")),
                   f"{run_folder(spark, 'typed')}/source")
    stats = upsert_partitions(spark, table, source, ["o_orderkey"], source_unique=True)
    if len(stats.partitions_rewritten) <= 32:
        raise RuntimeError("expected more partitions")
    return spark.table(table).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                     "priority", "dear", "share")


def q_publish_new_column(spark, sf_dir):
    """K4: a column that the table has not yet reaches it with the upsert."""
    db, _ = _lake(spark, "grown")
    table = f"{db}.customer"
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    write_table(customer, table, ["c_mktsegment"])
    source = customer.where("c_acctbal < 0").withColumn("debt", -F.col("c_acctbal"))
    upsert_partitions(spark, table, source, ["c_custkey"])
    return spark.table(table).select("c_custkey", "c_name", "c_acctbal", "debt", "c_mktsegment")


def q_latest_per_key_nested(spark, sf_dir):
    """A4 where only array, struct and map columns tell the rows apart."""
    ev = _read(spark, sf_dir, "events").select(
        "user_id", "event_type", F.struct("event_type", F.col("event_id").alias("n")).alias("s"),
        F.array("event_id").alias("a"), F.create_map(F.lit("n"), F.col("event_id")).alias("m"))
    by_array = latest_per_key(ev.drop("s", "m"), ["user_id"], ["event_type desc"])
    by_struct = latest_per_key(ev.drop("a", "m"), ["user_id"], ["event_type desc"])
    by_map = latest_per_key(ev.drop("a", "s"), ["user_id"], ["event_type desc"])
    return (by_array.select("user_id", "event_type", F.col("a")[0].alias("by_array"))
            .join(by_struct.select("user_id", F.col("s.n").alias("by_struct")), "user_id")
            .join(by_map.select("user_id", F.col("m")["n"].alias("by_map")), "user_id"))


def q_stream_cdc_to_bronze(spark, sf_dir):
    """Batch first load from full-load/, then cdc-load/ as a file stream."""
    from daylake.streaming import stream_to_bronze
    db, location = _lake(spark, "stream")
    table = f"{db}.events"
    root = landing(spark, sf_dir)
    raw_to_bronze(spark, EVENTS, root, table)
    query = stream_to_bronze(spark, EVENTS, root, table, f"{location}/_checkpoint")
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return _events_out(spark.table(table))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: bronze first load, gold first load, bronze upsert, gold
    upsert of every day the change files hold; returns the gold table."""
    bronze_db, _ = _lake(spark, "bronze")
    gold_db, _ = _lake(spark, "gold")
    bronze, gold = f"{bronze_db}.events", f"{gold_db}.events"
    root = landing(spark, sf_dir)
    raw_to_bronze(spark, EVENTS, root, bronze)
    bronze_to_gold(spark, EVENTS, bronze, gold)
    raw_to_bronze(spark, EVENTS, root, bronze)
    bronze_to_gold(spark, EVENTS, bronze, gold, day=days_from(spark, bronze, LANDING_SPLIT))
    return _events_out(spark.table(gold), props=False, parts=True)


def q_daily_chain(spark, sf_dir):
    """The cron flow, one day at a time to the last day of the data: after
    the first loads, each CDC day is loaded into bronze (one-day window) and
    then published to gold."""
    import datetime as dt
    bronze_db, _ = _lake(spark, "daily_bronze")
    gold_db, _ = _lake(spark, "daily_gold")
    bronze, gold = f"{bronze_db}.events", f"{gold_db}.events"
    root = landing(spark, sf_dir)
    raw_to_bronze(spark, EVENTS, root, bronze)
    bronze_to_gold(spark, EVENTS, bronze, gold)
    last = _read(spark, sf_dir, "events").agg(F.max(F.date_format("ts", "yyyy-MM-dd"))).first()[0]
    day = dt.date(int(LANDING_SPLIT[:4]), int(LANDING_SPLIT[4:6]), int(LANDING_SPLIT[6:]))
    while day <= dt.date.fromisoformat(last):
        # the job of the morning after ``day``: "cron" resolves to ``day``
        today = day + dt.timedelta(days=1)
        run_stages(spark, EVENTS, root, bronze, gold, "cron", today=today)
        day = today
    return _events_out(spark.table(gold), props=False, parts=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan_typed": q_csv_scan_typed,
    "landing_date_window": q_landing_date_window,
    "typed_mapping_bad_values": q_typed_mapping_bad_values,
    "cast_failure_counts": q_cast_failure_counts,
    "lineage_date_parts": q_lineage_date_parts,
    "gold_projection": q_gold_projection,
    "snake_case_columns": q_snake_case_columns,
    "latest_per_key": q_latest_per_key,
    "latest_per_composite_key": q_latest_per_composite_key,
    "partition_day_filter": q_partition_day_filter,
    "first_day_rows": q_first_day_rows,
    "first_day_rows_join": q_first_day_rows_join,
    "agg_by_name_global": q_agg_by_name_global,
    "agg_by_name_grouped": q_agg_by_name_grouped,
    "merge_upsert": q_merge_upsert,
    "merge_upsert_composite": q_merge_upsert_composite,
    "unmatched_rows": q_unmatched_rows,
    "replace_by_key": q_replace_by_key,
    "union_all_by_name": q_union_all_by_name,
    "partitioned_write_roundtrip": q_partitioned_write_roundtrip,
    "catalog_register_read": q_catalog_register_read,
    "table_exists_nonempty": q_table_exists_nonempty,
    "truncate_table": q_truncate_table,
    "load_source_switch": q_load_source_switch,
    "run_report": q_run_report,
    "upsert_shuffle_join": q_upsert_shuffle_join,
    "upsert_typed_partitions": q_upsert_typed_partitions,
    "publish_new_column": q_publish_new_column,
    "latest_per_key_nested": q_latest_per_key_nested,
    "gold_days_list": q_gold_days_list,
    "gold_initial_all": q_gold_initial_all,
    "stream_cdc_to_bronze": q_stream_cdc_to_bronze,
    "bronze_to_gold": flagship,
    "daily_chain": q_daily_chain,
}
