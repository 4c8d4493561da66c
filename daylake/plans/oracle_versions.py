"""DuckDB SQL for the queries of ``queries_versions``."""

from __future__ import annotations

from daylake.plans import queries as Q
from daylake.plans import queries_versions as V
from daylake.plans.oracle import ORACLE as TABLE_ORACLE
from daylake.plans.oracle import YMD, cdc_w, first_w, last_events

YEAR = "strftime(o_orderdate, '%Y')"
CHEAP = Q.CHEAP
BAD = f"event_id % {Q.BAD_KEY_EVERY} IN (0, 1) OR user_id IS NULL"
LATE = f"extract(day FROM ts)::INT % {V.LATE_EVERY} = 0"

LOADS = (
    f"WITH e AS (SELECT *, {first_w} AS first, CASE WHEN {BAD} THEN NULL ELSE user_id END AS u, "
    f"event_id % {Q.BAD_KEY_EVERY} = 0 AS bad FROM events), "
    "n AS (SELECT count(*) FILTER (first) AS rows1, count(*) FILTER (NOT first) AS rows2, "
    "count(DISTINCT u) FILTER (first) AS keys1, count(DISTINCT u) FILTER (NOT first) AS keys2, "
    "count(DISTINCT u) AS keys, count(*) FILTER (first AND u IS NULL) AS null1, "
    "count(*) FILTER (NOT first AND u IS NULL) AS null2, count(*) FILTER (first AND bad) AS bad1, "
    "count(*) FILTER (NOT first AND bad) AS bad2 FROM e), "
    # the rows without a key of one load are one row in bronze
    "k AS (SELECT *, least(null1, 1) AS one1, least(null2, 1) AS one2 FROM n) ")

ORACLE: dict[str, str] = {
    "merge_on_condition": TABLE_ORACLE["merge_upsert_composite"],
    "snapshot_after_upsert":
        "WITH o AS (SELECT o_orderkey, "
        f"CASE WHEN o_totalprice < {CHEAP / 4} THEN '1990' ELSE {YEAR} END AS o_year, "
        f"CASE WHEN o_totalprice < {CHEAP / 4} THEN 'Y' WHEN o_totalprice < {CHEAP} THEN 'Z' ELSE o_orderstatus END "
        "AS o_orderstatus FROM orders) SELECT o_year, o_orderstatus, "
        + ", ".join(f"count(*) AS {n}_rows, sum(o_orderkey)::BIGINT AS {n}_keys" for n in ("catalog", "path", "registered"))
        + " FROM o GROUP BY 1, 2",
    "publish_wider_type":
        f"SELECT o_orderkey, o_custkey + CASE WHEN o_totalprice < {CHEAP} THEN 3000000000 ELSE 0 END AS o_custkey, "
        f"CASE WHEN o_totalprice < {CHEAP} THEN 'W' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, "
        f"{YEAR} AS o_year, strftime(o_orderdate::DATE, '%Y-%m-%d') || "
        f"CASE WHEN o_totalprice >= {CHEAP} AND o_custkey % 2 = 0 THEN ' 01:30:00' ELSE ' 00:00:00' END AS o_orderdate "
        "FROM orders",
    "upsert_two_writers":
        "WITH o AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN 'A' ELSE o_orderstatus END AS before FROM orders) "
        f"SELECT o_orderkey, CASE WHEN o_totalprice < {CHEAP} THEN 'S' WHEN o_totalprice > {2 * CHEAP} THEN 'F' "
        f"ELSE before END AS o_orderstatus, {YEAR} AS o_year, before AS status_read_before FROM o",
    "upsert_key_index":
        "SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey "
        f"LIMIT {V.RARE_KEYS}) THEN 'R' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, {YEAR} AS o_year FROM orders",
    "remove_orphans":
        f"SELECT o_orderkey, CASE WHEN o_totalprice < {CHEAP} THEN 'Z' ELSE o_orderstatus END AS o_orderstatus, "
        f"{YEAR} AS o_year FROM orders",
    "truncate_restore":
        f"SELECT CASE WHEN o_totalprice < {CHEAP} THEN 'Z' ELSE o_orderstatus END AS o_orderstatus, count(*) AS n_rows, "
        "0 AS rows_by_name, 0 AS rows_by_path FROM orders GROUP BY 1",
    "quarantine":
        f"SELECT 'loaded' AS kind, user_id::VARCHAR AS key, year_month_day, NULL::VARCHAR AS bad_column, "
        f"NULL::VARCHAR AS bad_value, true AS file_matches FROM ({last_events(f'NOT ({BAD})')}) "
        f"UNION ALL SELECT CASE WHEN event_id % {Q.BAD_KEY_EVERY} = 0 THEN 'bad value' ELSE 'no key' END, "
        f"event_id::VARCHAR, {YMD}, 'user_id', CASE WHEN event_id % {Q.BAD_KEY_EVERY} = 0 THEN 'x' END, true "
        f"FROM events WHERE {BAD}",
    "quarantine_counts":
        LOADS + "SELECT 'first' AS load_kind, rows1 AS qtty_source, null1 AS rows_quarantined, "
        "rows1 - null1 - keys1 AS rows_dropped, keys1 AS rows_loaded FROM k "
        "UNION ALL SELECT 'upsert', rows2, null2, rows2 - null2 - keys2, keys2 FROM k",
    "header_binding": last_events("true"),
    "late_files":
        f"SELECT *, (SELECT count(*) FROM events WHERE {cdc_w} AND NOT ({LATE})) AS load_1, "
        f"(SELECT count(*) FROM events WHERE {cdc_w} AND {LATE}) AS load_2, 0::BIGINT AS load_3 "
        f"FROM ({last_events('true')})",
    "reprocess_all": last_events("true"),
    "run_log":
        LOADS + "SELECT 'bronze' AS stage, 'first' AS load_kind, 0::BIGINT AS qtty_before, rows1 AS qtty_source, "
        "keys1 + one1 AS qtty_after, null1 AS null_keys, bad1 AS bad_values, 0::BIGINT AS corrupt_lines, "
        "rows1 - keys1 - one1 AS rows_dropped, false AS has_undated FROM k, range(2) "
        "UNION ALL SELECT unnest(['bronze', 'stream']), 'upsert', keys1 + one1, rows2, keys + one1 + one2, null2, bad2, 0, "
        "rows2 - keys2 - one2, true FROM k "
        "UNION ALL SELECT 'gold', 'first', 0, keys + one1 + one2, keys + one1 + one2, one1 + one2, 0, NULL, 0, false FROM k",
}
