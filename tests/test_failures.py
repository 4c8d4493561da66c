"""Failure behaviour: retried writers do not duplicate, failed upserts
leave the table as it was."""

import pytest
from pyspark.sql import functions as F

from daylake.functions.mapping import raw_schema
from daylake.plans.publish import upsert_partitions, write_table
from daylake.plans.landed import write_dated_csv
from daylake.sources.landing import scan_dated

SCHEMA = "k long, v string, year string, month string, day string"


def test_rewriting_landing_files_replaces_them(spark, tmp_path):
    root = str(tmp_path / "land")
    df = spark.range(100).select(F.col("id").alias("k"),
                                 F.format_string("202401%02d", F.col("id") % 3 + 1).alias("d"))
    for _ in range(2):  # a retried task writes the same file names again
        write_dated_csv(df.repartition(4), root, "d").agg(F.sum("rows")).collect()
    back = scan_dated(spark, root, raw_schema(["k"]))
    assert back.count() == 100


def test_failed_upsert_leaves_table_unchanged(spark, lake):
    table = f"{lake}.safe"
    write_table(spark.createDataFrame([(1, "a", "2024", "02", "01"), (2, "b", "2024", "02", "02")],
                                      SCHEMA), table, ["year", "month", "day"])
    before = sorted(tuple(r) for r in spark.table(table).collect())
    src = spark.createDataFrame([(1, "x", "2024", "02", "03"), (3, "boom", "2024", "02", "01")],
                                SCHEMA)
    # the value column fails only when the rewrite is written
    src = src.withColumn("v", F.when(F.col("v") == "boom", F.raise_error(F.lit("boom")))
                         .otherwise(F.col("v")))
    with pytest.raises(Exception):
        upsert_partitions(spark, table, src, ["k"])
    spark.catalog.refreshTable(table)
    assert sorted(tuple(r) for r in spark.table(table).collect()) == before


def test_null_key_third_spreads_in_shuffle_path(spark, lake):
    """A third of the target has NULL keys; with the sort-merge path (AQE
    and auto-broadcast off) the result is exact and those rows are spread
    over many shuffle partitions instead of one."""
    from daylake.plans.publish import plan_upsert
    from daylake.session import conf_override
    table = f"{lake}.nulls"
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").cast("string").alias("v"), F.lit("2024").alias("year"),
        F.lit("02").alias("month"), F.format_string("%02d", F.col("id") % 5 + 1).alias("day"))
    write_table(rows, table, ["year", "month", "day"])
    src = spark.createDataFrame([(1, "new", "2024", "02", "09"), (None, "n", "2024", "02", "09")],
                                SCHEMA)
    static = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
              "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with conf_override(spark, static):
        plan = plan_upsert(spark, table, src, ["k"], broadcast_rows=0)
        assert not plan.stats.broadcast and plan.stats.rows_matched == 1
        # NULL-key rows go past the join: its target side reads non-NULL keys
        text = plan.rewrite._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "isnull(k" in text and "isnotnull(k" in text
        upsert_partitions(spark, table, src, ["k"], broadcast_rows=0)
    assert spark.table(table).where("k is null").count() == 1001
    assert spark.table(table).count() == 3000 + 1
