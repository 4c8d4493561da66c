"""Write PLANS.md: the executed (final, after AQE) physical plan of each
hot-path operator, with the files / partitions its scans read.

    python explain.py [SF_DIR]      # default /root/testdata/sf0.1
"""

from __future__ import annotations

import os
import re
import sys
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from daylake.functions.mapping import raw_schema  # noqa: E402
from daylake.operators.aggregate import aggregate_by_name, rows_at_earliest  # noqa: E402
from daylake.operators.dedup import latest_per_key  # noqa: E402
from daylake.operators.filters import day_filter  # noqa: E402
from daylake.operators.upsert import unmatched  # noqa: E402
from daylake.plans import queries as Q  # noqa: E402
from daylake.plans.datasets import EVENTS  # noqa: E402
from daylake.plans.jobs import conform, earliest_day, raw_to_bronze  # noqa: E402
from daylake.plans import key_index, manifest  # noqa: E402
from daylake.plans.publish import (key_frame, plan_upsert, read_version, stage, stats_frame,  # noqa: E402
                                   table_location)
from daylake.session import conf_override, get_session, run_folder  # noqa: E402
from daylake.sources.landing import scan_by_header, scan_dated  # noqa: E402

NOTES = {
    "dated_scan": "Window 2024-01-10..11 over full-load/. The name-date filter is a "
                  "metadata filter on `_metadata.file_name`: only the files of the window "
                  "are opened (see files read).",
    "latest_per_key": "One hash exchange on the key; `WindowGroupLimit` runs before it "
                      "(Partial) and after it (Final), so each map task sends at most one "
                      "row per key, whatever the key skew.",
    "first_load_write": "Partitioned write of the deduplicated rows. The REBALANCE hint adds "
                        "`Exchange ... REBALANCE_PARTITIONS_BY_COL`; AQE coalesces small days "
                        "and splits a large one, so files per day stay bounded.",
    "upsert_stats": "Per-partition rows and matched rows of the target. Reads only the key "
                    "column (ReadSchema) and partition values; source keys are broadcast "
                    "after a size check; partial aggregation before the tiny exchange.",
    "upsert_stats_shuffle": "The same stats pass when the source keys fail the broadcast "
                            "check (shown with AQE and auto-broadcast off, i.e. the plan a "
                            "large source gets): a sort-merge left join whose target side "
                            "shuffles only the key and partition columns (ReadSchema); "
                            "rows with a NULL key go past the join.",
    "upsert_stats_by_index": "The same stats pass with a key index, for a source of one key: only the "
                             "folders whose key range and Bloom filter admit it are scanned, by the "
                             "manifest's version.",
    "read_version": "The table read by path at its latest version: one scan of the first load's folders "
                    "and one of the folders of later runs.",
    "header_binding": "CSV bound by header names: one scan per distinct header, unioned by name.",
    "upsert_rewrite": "Rewrite of the touched partitions only: `PartitionFilters` on the "
                      "target scan, broadcast anti join, union with the staged source. No "
                      "shuffle of the target.",
    "upsert_rewrite_shuffle": "The rewrite when the source keys fail the broadcast check and the "
                              "target holds many of them: a sort-merge anti join, then a "
                              "REBALANCE on the partition columns, so files per day stay few.",
    "gold_day": "Gold source: one bronze day by literal partition predicates "
                "(`PartitionFilters`), one partition read.",
    "first_day_join": "J1 on a plain frame: one-row min broadcast (size fixed at one row).",
    "aggregate_by_name": "Grouped aggregate: partial HashAggregate before the exchange.",
    "unmatched": "NOT EXISTS as `left_anti`; the filtered orders side is small here, AQE "
                 "may turn the join into a broadcast at runtime.",
}


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    try:
        plan = plan.finalPhysicalPlan()
    except Exception:
        pass
    return plan


def _leaves(node):
    """Leaf nodes, looking inside AQE query stages."""
    name = node.getClass().getSimpleName()
    if name.endswith("QueryStageExec"):
        yield from _leaves(node.plan())
        return
    if name == "ReusedExchangeExec":
        yield from _leaves(node.child())
        return
    kids = node.children()
    if kids.size() == 0:
        yield node
    for i in range(kids.size()):
        yield from _leaves(kids.apply(i))


def scans(plan):
    out = []
    for leaf in _leaves(plan):
        m = leaf.metrics()
        if m.contains("numFiles"):
            parts = m.apply("numPartitions").value() if m.contains("numPartitions") else None
            out.append(f"{leaf.nodeName().strip()}: files read {m.apply('numFiles').value()}"
                       + (f", partitions read {parts}" if parts is not None else "")
                       + f", rows {m.apply('numOutputRows').value()}")
    return out


def scan_details(text: str) -> list[str]:
    """PartitionFilters / PushedFilters / ReadSchema of every FileScan line."""
    out = []
    for line in text.splitlines():
        if "FileScan" not in line:
            continue
        table = re.search(r"FileScan (\w+)(?: (\S+?)\[|\s*\[)", line)
        fields = [f"{k}: {re.search(k + r': (\[[^\]]*\]|\S+)', line).group(1)}"
                  for k in ("PartitionFilters", "PushedFilters", "ReadSchema")
                  if re.search(k + r": ", line)]
        out.append(f"{table.group(1) if table else 'scan'} {table.group(2) or '' if table else ''}: "
                   + "; ".join(fields))
    return out


def tidy(text: str) -> str:
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"file:/\S+/daylake/", ".../", text)
    return "\n".join(line[:220] for line in text.splitlines())


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", extra={"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    root = Q.landing(spark, sf_dir)
    schema = raw_schema(EVENTS.raw_columns)
    frames = {}
    frames["dated_scan"] = scan_dated(spark, f"{root}/full-load", schema, "2024-01-10", "2024-01-11")
    typed = stage(conform(scan_dated(spark, [f"{root}/full-load", f"{root}/cdc-load"], schema),
                          EVENTS), f"{run_folder(spark, 'explain')}/typed")
    frames["latest_per_key"] = latest_per_key(typed, EVENTS.keys, EVENTS.order_by)
    db, _ = Q._lake(spark, "explain")
    bronze = f"{db}.events"
    raw_to_bronze(spark, EVENTS, root, bronze)
    frames["first_load_write"] = latest_per_key(typed, EVENTS.keys, EVENTS.order_by) \
        .hint("rebalance", *EVENTS.partitions)
    src = stage(day_filter(frames["latest_per_key"], ["20240130", "20240129"]),
                f"{run_folder(spark, 'explain')}/src")
    target = spark.table(bronze)
    replayed = src.where("user_id is null").select("file_name").distinct()
    for label, small in (("upsert_stats", True), ("upsert_stats_shuffle", False)):
        frames[label] = stats_frame(target, key_frame(src, EVENTS.keys, small, True), EVENTS.keys,
                                    EVENTS.partitions, replayed)
    indexed = f"{db}.events_indexed"
    raw_to_bronze(spark, replace(EVENTS, key_index=True), root, indexed)
    raw_to_bronze(spark, EVENTS, root, indexed)
    where, m = table_location(spark, indexed), manifest.latest(spark, table_location(spark, indexed))
    one = stage(src.limit(1), f"{run_folder(spark, 'explain')}/one")
    may = key_index.candidates(spark, where, m, one, EVENTS.keys, 1, False)
    frames["upsert_stats_by_index"] = stats_frame(manifest.frame(spark, where, m, may),
                                                  key_frame(one, EVENTS.keys, True, True), EVENTS.keys, EVENTS.partitions)
    frames["read_version"] = read_version(spark, indexed).groupBy("year", "month").count()
    frames["header_binding"] = scan_by_header(spark, f"{root}/full-load", schema, "2024-01-10", "2024-01-11",
                                              EVENTS.csv_options, ["user_id"])
    as_run = dict(source_unique=True, replay_by=["file_name"])
    plan = plan_upsert(spark, bronze, src, EVENTS.keys, **as_run)
    frames["upsert_rewrite"] = plan.rewrite
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        frames["upsert_rewrite_shuffle"] = plan_upsert(spark, bronze, src, EVENTS.keys,
                                                       broadcast_rows=0, **as_run).rewrite
    frames["gold_day"] = day_filter(spark.table(bronze), [earliest_day(spark, bronze)])
    frames["first_day_join"] = rows_at_earliest(typed, "year_month_day")
    frames["aggregate_by_name"] = aggregate_by_name(
        spark.read.parquet(f"{sf_dir}/orders.parquet"), ["o_orderstatus"],
        [("o_totalprice", "sum"), ("o_custkey", "countDistinct")])
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    frames["unmatched"] = unmatched(
        spark.read.parquet(f"{sf_dir}/customer.parquet"),
        orders.where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"])

    out = ["# PLANS", "",
           f"Executed physical plans (final, after AQE) at `{sf_dir}` on local[8], written "
           "by `python explain.py`. Expression ids and workspace paths are shortened.", ""]
    static = {"spark.sql.adaptive.enabled": "false",
              "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, df in frames.items():
        if name.endswith("_shuffle"):  # the rewrite needs AQE for its REBALANCE
            settings = static if name == "upsert_stats_shuffle" else {
                "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
            with conf_override(spark, settings):
                p = final_plan(df)
        else:
            p = final_plan(df)
        out += [f"## {name}", "", NOTES[name], ""]
        out += [f"- {s}" for s in scans(p)]
        out += [f"- `{tidy(d)}`" for d in scan_details(p.toString())]
        if plan.stats and name == "upsert_rewrite":
            out += [f"- partitions rewritten {len(plan.stats.partitions_rewritten)}, "
                    f"dropped {len(plan.stats.partitions_dropped)}, broadcast {plan.stats.broadcast}"]
        out += ["", "```", tidy(p.toString()), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
