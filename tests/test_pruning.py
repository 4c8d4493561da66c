"""Scale claims checked on executed plans: files and partitions read."""

from pyspark.sql import functions as F

from daylake.functions.mapping import RAW_POLICY, raw_schema
from daylake.operators.filters import day_filter, partition_predicate
from daylake.plans.publish import write_table
from daylake.sources.landing import scan_dated


def scan_metrics(df):
    """Run the frame's own plan; return (node, files, partitions, rows) per scan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    try:
        plan = plan.finalPhysicalPlan()
    except Exception:
        pass
    leaves = plan.collectLeaves()
    out = []
    for i in range(leaves.size()):
        m = leaves.apply(i).metrics()
        get = lambda k: m.apply(k).value() if m.contains(k) else None
        out.append((leaves.apply(i).nodeName(), get("numFiles"), get("numPartitions"),
                    get("numOutputRows")))
    return out


def test_name_date_window_opens_only_matching_files(spark, policy_landing):
    df = scan_dated(spark, f"{policy_landing}/cdc-load", raw_schema(RAW_POLICY),
                    "2024-02-03", "2024-02-03")
    (_, files, _, rows), = scan_metrics(df)
    assert files == 1 and rows == 2   # 3 csv files in the folder


def test_day_filter_reads_one_partition(spark, lake):
    table = f"{lake}.days"
    df = spark.range(300).select(
        F.col("id").alias("k"), F.lit("2024").alias("year"), F.lit("01").alias("month"),
        F.format_string("%02d", (F.col("id") % 10) + 1).alias("day"))
    write_table(df, table, ["year", "month", "day"])
    (_, files, parts, rows), = scan_metrics(day_filter(spark.table(table), ["20240103"]))
    assert parts == 1 and rows == 30
    got = scan_metrics(spark.table(table).where(
        partition_predicate(["year", "month", "day"], [("2024", "01", "02"), ("2024", "01", "05")])))
    assert got[0][2] == 2


def test_upsert_rewrite_reads_only_touched_partitions(spark, lake):
    from daylake.plans.publish import plan_upsert
    table = f"{lake}.up"
    rows = spark.range(200).select(
        F.col("id").alias("k"), F.lit("x").alias("v"), F.lit("2024").alias("year"),
        F.lit("01").alias("month"), F.format_string("%02d", (F.col("id") % 10) + 1).alias("day"))
    write_table(rows, table, ["year", "month", "day"])
    # keys 3 and 13 live in day 04; the source moves them to day 11
    src = spark.createDataFrame([(3, "y", "2024", "01", "11"), (13, "y", "2024", "01", "11")],
                                "k long, v string, year string, month string, day string")
    plan = plan_upsert(spark, table, src, ["k"])
    assert plan.stats.partitions_rewritten == [("2024", "01", "04"), ("2024", "01", "11")]
    assert plan.stats.partitions_dropped == [] and plan.stats.broadcast
    scans = scan_metrics(plan.rewrite)
    table_scan = [s for s in scans if "up" in s[0]]
    assert table_scan and all(s[2] == 1 for s in table_scan)  # day 11 is new: 1 partition read
    assert "BroadcastHashJoin" in plan.rewrite._jdf.queryExecution().executedPlan().toString()


def test_partitioned_write_splits_a_hot_day_and_bounds_files(spark, lake, tmp_path):
    import os
    from daylake.session import conf_override
    rows = (spark.range(60000)
            .select(F.col("id").alias("k"), (F.rand(7) * 1e6).alias("v"),
                    F.lit("2024").alias("year"), F.lit("01").alias("month"),
                    F.when(F.col("id") % 3 == 0, F.lit("01"))
                     .otherwise(F.format_string("%02d", F.col("id") % 30 + 1)).alias("day"))
            .repartition(16, "k"))  # like the dedup output: hashed by key
    with conf_override(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                               "spark.sql.shuffle.partitions": "16"}):
        write_table(rows, f"{lake}.hot", ["year", "month", "day"])
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {lake}.hot") \
        .where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    files = {}
    for folder, _, names in os.walk(location):
        n = sum(1 for f in names if f.endswith(".parquet"))
        if n:
            files[os.path.basename(folder)] = n
    days = rows.select("day").distinct().count()
    assert len(files) == days
    assert files["day=01"] > 1                      # the hot day is split
    assert sum(files.values()) < 16 * days           # not one file per task per day
    assert spark.table(f"{lake}.hot").count() == 60000


def test_many_partition_predicate_is_flat_and_prunes(spark, lake):
    table = f"{lake}.many"
    rows = spark.range(400).select(
        F.col("id").alias("k"), F.lit("2024").alias("year"),
        F.format_string("%02d", (F.col("id") % 12) + 1).alias("month"),
        F.format_string("%02d", (F.col("id") % 28) + 1).alias("day"))
    write_table(rows, table, ["year", "month", "day"])
    wanted = [("2024", f"{m:02d}", f"{d:02d}") for m in range(1, 13) for d in range(1, 29)]
    wanted = [w for w in wanted if w[1] in ("01", "02")] + \
        [(str(y), "01", "01") for y in range(1000, 6000)]      # 5000 that do not exist
    pred = partition_predicate(["year", "month", "day"], wanted)
    got = spark.table(table).where(pred)
    expected = rows.where(F.col("month").isin("01", "02")).count()
    (_, _, parts, n), = scan_metrics(got)
    assert n == expected and parts == rows.where(F.col("month").isin("01", "02")) \
        .select("month", "day").distinct().count()
