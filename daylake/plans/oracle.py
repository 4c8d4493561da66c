"""DuckDB SQL for each driver query, written from the tables directly.

The file-name date of a landed event is the day of its timestamp, so the
SQL uses ``strftime(ts, '%Y%m%d')`` wherever the Spark side reads the date
from a file name. ``LAST(...)`` is the latest row per key with the same
total order the Spark side uses (file date desc, then event_id desc).
"""

from __future__ import annotations

from daylake.plans import queries as Q

YMD = "strftime(ts, '%Y%m%d')"
TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
SPLIT = Q.LANDING_SPLIT


def _compact(iso: str) -> str:
    return iso.replace("-", "")


def events_rows(where: str) -> str:
    return (f"SELECT event_id, {TS} AS ts, user_id, event_type, value, props, "
            f"{YMD} AS year_month_day FROM events WHERE {where}")


def last_events(where: str) -> str:
    return ("SELECT event_id, ts, user_id, event_type, value, props, year_month_day FROM ("
            "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "
            "year_month_day DESC NULLS LAST, event_id DESC NULLS LAST) AS rn "
            f"FROM ({events_rows(where)})) WHERE rn = 1")


LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
           "l_discount, l_tax, l_returnflag, l_linestatus")
LI_TIE = ", ".join(f"{c} DESC NULLS LAST" for c in [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus"])


def last_lineitem(where: str) -> str:
    return (f"SELECT {LI_COLS}, CAST(l_shipdate AS DATE) AS l_shipdate FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            f"ORDER BY {LI_TIE}) AS rn FROM lineitem WHERE {where}) WHERE rn = 1")


def spark_bigint(text: str) -> str:
    """Spark's string -> bigint: optional sign and digits only, after trim."""
    return (f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({text}) AS BIGINT) END")


ORDERS_OUT = ("o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
              "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority")
AGGS = ("round(sum(o_totalprice), 2) AS sum_o_totalprice, "
        "round(avg(o_totalprice), 2) AS avg_o_totalprice, "
        "round(stddev_pop(o_totalprice), 2) AS stddev_pop_o_totalprice, "
        "round(stddev_samp(o_totalprice), 2) AS stddev_samp_o_totalprice, "
        "min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice, "
        "count(o_orderkey) AS count_o_orderkey, "
        'count(DISTINCT o_custkey) AS "countDistinct_o_custkey"')
GOLD_COLS = "event_id, ts, user_id, event_type, value, year_month_day"
ACCTBAL_TEXT = "CAST(c_acctbal AS VARCHAR)"


def replace(target: str, source: str, keys: list[str], cols: str = "*") -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return (f"SELECT {cols} FROM ({target}) t WHERE NOT EXISTS "
            f"(SELECT 1 FROM ({source}) s WHERE {on}) "
            f"UNION ALL SELECT {cols} FROM ({source}) s2")


first_w, cdc_w = f"{YMD} < '{SPLIT}'", f"{YMD} >= '{SPLIT}'"

gold_all = (f"SELECT {GOLD_COLS}, substr(year_month_day, 1, 4) AS year, "
            "substr(year_month_day, 5, 2) AS month, substr(year_month_day, 7, 2) AS day "
            f"FROM ({last_events('true')})")

ORACLE: dict[str, str] = {
    "csv_scan_typed":
        f"SELECT event_id, {TS} AS ts, user_id, event_type, value, props FROM events",
    "landing_date_window":
        f"SELECT {YMD} AS year_month_day, count(*) AS n_rows FROM events "
        f"WHERE {YMD} BETWEEN '{_compact(Q.WINDOW[0])}' AND '{_compact(Q.WINDOW[1])}' "
        f"AND {first_w} GROUP BY 1",
    "typed_mapping_bad_values":
        f"SELECT c_custkey, {spark_bigint('c_name')} AS name_as_bigint, c_nationkey, "
        f"c_acctbal, {spark_bigint(ACCTBAL_TEXT)} AS acctbal_as_bigint, "
        "TRY_CAST(c_mktsegment AS DATE) AS segment_as_date, c_mktsegment FROM customer",
    "cast_failure_counts":
        "SELECT count(*) FILTER (WHERE c_custkey IS NOT NULL AND "
        "TRY_CAST(CAST(c_custkey AS VARCHAR) AS BIGINT) IS NULL) AS bad_c_custkey, "
        f"count(*) FILTER (WHERE c_name IS NOT NULL AND {spark_bigint('c_name')} IS NULL) "
        "AS bad_name_as_bigint, "
        "count(*) FILTER (WHERE c_nationkey IS NOT NULL AND "
        "TRY_CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) IS NULL) AS bad_c_nationkey, "
        "count(*) FILTER (WHERE c_acctbal IS NOT NULL AND "
        "TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) IS NULL) AS bad_c_acctbal, "
        f"count(*) FILTER (WHERE c_acctbal IS NOT NULL AND {spark_bigint(ACCTBAL_TEXT)} "
        "IS NULL) AS bad_acctbal_as_bigint, "
        "count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND "
        "TRY_CAST(c_mktsegment AS DATE) IS NULL) AS bad_segment_as_date FROM customer",
    "lineage_date_parts":
        f"SELECT event_id, {YMD} AS year_month_day, strftime(ts, '%Y') AS year, "
        "strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, true AS name_matches "
        "FROM events",
    "gold_projection":
        "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, "
        "o_totalprice AS total_price, CAST(o_orderdate AS DATE) AS order_date FROM orders",
    "snake_case_columns":
        "SELECT o_orderkey AS order_key, o_custkey AS customer_id, "
        "o_orderstatus AS order_status, o_totalprice AS total_price, "
        "CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS html_order_priority "
        "FROM orders",
    "latest_per_key": last_events("true"),
    "latest_per_composite_key": last_lineitem("true"),
    "partition_day_filter": events_rows(f"{YMD} = '{Q.ONE_DAY}'"),
    "first_day_rows": events_rows(f"{YMD} = (SELECT min({YMD}) FROM events)"),
    "first_day_rows_join": events_rows(f"{YMD} = (SELECT min({YMD}) FROM events)"),
    "agg_by_name_global": f"SELECT {AGGS} FROM orders",
    "agg_by_name_grouped":
        f"SELECT o_orderstatus, o_orderpriority, {AGGS} FROM orders GROUP BY 1, 2",
    "merge_upsert": replace(
        last_events(first_w),
        last_events(cdc_w),
        ["user_id"]),
    "merge_upsert_composite": replace(
        last_lineitem(f"l_shipdate < TIMESTAMP '{Q.LINEITEM_TARGET_BEFORE}'"),
        last_lineitem(f"l_shipdate >= TIMESTAMP '{Q.LINEITEM_SOURCE_FROM}'"),
        ["l_orderkey", "l_linenumber"]),
    "unmatched_rows":
        "SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o "
        f"WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > {Q.PRICE_LIMIT})",
    "replace_by_key": replace(
        last_events(f"{YMD} <= '{Q.REPLACE_UNTIL}'"),
        f"SELECT * FROM ({last_events('true')}) WHERE year_month_day > '{Q.REPLACE_UNTIL}'",
        ["user_id"], GOLD_COLS),
    "union_all_by_name":
        f"SELECT {ORDERS_OUT} FROM orders WHERE o_orderdate < TIMESTAMP '{Q.ORDERS_CUTOFF}' "
        f"UNION ALL SELECT {ORDERS_OUT} FROM orders WHERE NOT "
        f"(o_orderdate < TIMESTAMP '{Q.ORDERS_CUTOFF}') OR o_orderdate IS NULL",
    "partitioned_write_roundtrip":
        "SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
        "strftime(ts, '%d') AS day, count(*) AS n_rows FROM events GROUP BY 1, 2, 3",
    "catalog_register_read": f"SELECT {ORDERS_OUT} FROM orders",
    "table_exists_nonempty":
        "SELECT true AS path_exists, true AS table_exists, count(*) > 0 AS nonempty, "
        "false AS missing_exists, false AS empty_nonempty, count(*) AS n_rows FROM nation",
    "truncate_table":
        "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM nation",
    "load_source_switch": last_events("true"),
    "stream_cdc_to_bronze": last_events("true"),
    "upsert_shuffle_join": last_events("true"),
    "run_report":
        f"WITH e AS (SELECT *, {first_w} AS first, CASE WHEN event_id % {Q.BAD_KEY_EVERY} = 0 "
        f"THEN NULL ELSE user_id END AS u FROM events), "
        "n AS (SELECT count(*) FILTER (first) AS rows1, count(*) FILTER (NOT first) AS rows2, "
        "count(DISTINCT u) FILTER (first) AS keys1, count(DISTINCT u) FILTER (NOT first) AS keys2, "
        "count(DISTINCT u) AS keys, count(*) FILTER (first AND u IS NULL) AS null1, "
        "count(*) FILTER (NOT first AND u IS NULL) AS null2, "
        f"count(*) FILTER (first AND event_id % {Q.BAD_KEY_EVERY} = 0) AS bad1, "
        f"count(*) FILTER (NOT first AND event_id % {Q.BAD_KEY_EVERY} = 0) AS bad2 FROM e), "
        # the rows without a key of one load are one row in bronze
        "k AS (SELECT *, least(null1, 1) AS one1, least(null2, 1) AS one2 FROM n) "
        "SELECT 'bronze' AS stage, 'first' AS load_kind, 0::BIGINT AS qtty_before, rows1 AS qtty_source, "
        "keys1 + one1 AS qtty_after, null1 AS null_keys, bad1 AS bad_values, "
        "rows1 - keys1 - one1 AS rows_dropped FROM k "
        "UNION ALL SELECT 'bronze', 'upsert', keys1 + one1, rows2, keys + one1 + one2, null2, bad2, "
        "rows2 - keys2 - one2 FROM k "
        "UNION ALL SELECT 'gold', 'first', 0, keys + one1 + one2, keys + one1 + one2, one1 + one2, 0, 0 FROM k",
    "upsert_typed_partitions":
        f"SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice < {Q.CHEAP} THEN 'Z' ELSE o_orderstatus END "
        "AS o_orderstatus, o_totalprice, o_orderpriority AS priority, "
        f"o_totalprice > {Q.PRICE_LIMIT / 2} AS dear, (o_custkey % 8) / 4.0::DOUBLE AS share FROM orders",
    "publish_new_column":
        "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN -c_acctbal END AS debt, "
        "c_mktsegment FROM customer",
    "latest_per_key_nested":
        "SELECT user_id, event_type, event_id AS by_array, event_id AS by_struct, event_id AS by_map FROM ("
        "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC NULLS LAST, "
        "event_id DESC NULLS LAST) AS rn FROM events) WHERE rn = 1 AND user_id IS NOT NULL",
    "daily_chain": gold_all,
    "gold_days_list": (
        f"WITH b AS ({last_events('true')}), "
        "g1 AS (SELECT * FROM b WHERE year_month_day = (SELECT min(year_month_day) FROM b)), "
        f"s AS (SELECT * FROM b WHERE year_month_day IN "
        f"({', '.join(repr(d) for d in Q.GOLD_DAYS)})), "
        "g2 AS (SELECT * FROM g1 t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = t.user_id) "
        "UNION ALL SELECT * FROM s) "
        f"SELECT {GOLD_COLS}, substr(year_month_day, 1, 4) AS year, "
        "substr(year_month_day, 5, 2) AS month, substr(year_month_day, 7, 2) AS day FROM g2"),
    "gold_initial_all": gold_all,
    "bronze_to_gold": gold_all,
}
