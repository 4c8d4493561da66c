import os

from pyspark.sql import functions as F

from daylake.plans.publish import (create_database, register_external, truncate,
                                   upsert_partitions, write_table)
from daylake.sources.tables import (is_nonempty, partition_columns, path_exists,
                                    table_exists)

SCHEMA = "k long, v string, year string, month string, day string"


def _rows(spark, table):
    return sorted((r["k"] if r["k"] is not None else -1, r["v"], r["day"])
                  for r in spark.table(table).collect())


def _partitions(spark, table):
    return sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def _first(spark, lake, rows):
    table = f"{lake}.t"
    write_table(spark.createDataFrame(rows, SCHEMA), table, ["year", "month", "day"])
    return table


def test_upsert_moves_keys_and_drops_emptied_partitions(spark, lake):  # K2, §7.3
    table = _first(spark, lake, [(1, "a", "2024", "02", "01"), (2, "b", "2024", "02", "01"),
                                 (3, "c", "2024", "02", "02")])
    src = spark.createDataFrame([(1, "A", "2024", "02", "03"), (2, "B", "2024", "02", "03"),
                                 (4, "D", "2024", "02", "02")], SCHEMA)
    stats = upsert_partitions(spark, table, src, ["k"])
    assert _rows(spark, table) == [(1, "A", "03"), (2, "B", "03"), (3, "c", "02"), (4, "D", "02")]
    assert _partitions(spark, table) == ["year=2024/month=02/day=02", "year=2024/month=02/day=03"]
    assert (stats.rows_before, stats.rows_source, stats.rows_matched, stats.rows_after) == (3, 3, 2, 4)
    assert stats.partitions_dropped == [("2024", "02", "01")]
    assert stats.broadcast


def test_upsert_keeps_unmatched_rows_of_a_written_partition(spark, lake):
    table = _first(spark, lake, [(1, "a", "2024", "02", "01"), (2, "b", "2024", "02", "01")])
    src = spark.createDataFrame([(3, "c", "2024", "02", "01")], SCHEMA)
    upsert_partitions(spark, table, src, ["k"])
    assert _rows(spark, table) == [(1, "a", "01"), (2, "b", "01"), (3, "c", "01")]


def test_upsert_twice_is_once_and_shuffle_path_agrees(spark, lake):  # properties
    rows = [(k, f"v{k}", "2024", "01", f"{k % 5 + 1:02d}") for k in range(40)]
    src_rows = [(k, f"w{k}", "2024", "01", f"{k % 3 + 4:02d}") for k in range(20, 60)]
    a = _first(spark, lake, rows)
    src = spark.createDataFrame(src_rows, SCHEMA)
    s1 = upsert_partitions(spark, a, src, ["k"])
    once = _rows(spark, a)
    upsert_partitions(spark, a, src, ["k"])
    assert _rows(spark, a) == once
    assert s1.rows_after == s1.rows_before - s1.rows_matched + s1.rows_source == 60
    assert spark.table(a).groupBy("k").count().where("count > 1").count() == 0
    b = f"{lake}.u"
    write_table(spark.createDataFrame(rows, SCHEMA), b, ["year", "month", "day"])
    s2 = upsert_partitions(spark, b, src, ["k"], broadcast_rows=0)
    assert not s2.broadcast and _rows(spark, b) == once


def test_null_keys_never_match(spark, lake):  # D14
    table = _first(spark, lake, [(None, "n1", "2024", "02", "01")])
    upsert_partitions(spark, table, spark.createDataFrame([(None, "n2", "2024", "02", "01")], SCHEMA), ["k"])
    assert _rows(spark, table) == [(-1, "n1", "01"), (-1, "n2", "01")]


def test_catalog_ddl(spark, tmp_path):  # K7, K8, S6, S8, S9, S10, K5
    db = "ddl_db"
    create_database(spark, db, str(tmp_path / db), comment="it's ours",
                    properties={"owner": "lake-admin", "description": "x"})
    props = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {db}").collect()}
    assert "data_owner" in str(props.get("Properties", ""))
    path = str(tmp_path / "files")
    spark.createDataFrame([(1, "01"), (2, "02")], "k long, day string") \
        .write.partitionBy("day").parquet(path)
    register_external(spark, f"{db}.ext", "k long, day string", path, ["day"])
    assert spark.table(f"{db}.ext").count() == 2
    assert partition_columns(spark, f"{db}.ext") == ["day"]
    assert table_exists(spark, f"{db}.ext") and not table_exists(spark, f"{db}.nope")
    assert not table_exists(spark, "no_such_db.t")
    assert path_exists(spark, path) and not path_exists(spark, path + "_x")
    write_table(spark.createDataFrame([(1,)], "k long"), f"{db}.m", [])
    assert is_nonempty(spark.table(f"{db}.m"))
    truncate(spark, f"{db}.m")
    assert not is_nonempty(spark.table(f"{db}.m"))
    assert os.path.isdir(str(tmp_path / db))


def test_sql_ddl_files_register_bronze_files(spark, tmp_path):  # K7, K8 as SQL
    from daylake.plans.publish import run_sql_file
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    files = str(tmp_path / "bronze_files")
    (spark.createDataFrame(
        [(1, "2024-12-31", "Urban", "NY", "East", 100.5, "Retail", "N", "N", "f_20240201.csv",
          "20240201", "2024", "02", "01")],
        "policy_id long, expiry_date string, location_name string, state_code string, "
        "region_name string, insured_value double, business_type string, earth_quake string, "
        "flood string, file_name string, year_month_day string, year string, month string, "
        "day string")
        .withColumn("expiry_date", F.col("expiry_date").cast("date"))
        .write.partitionBy("year", "month", "day").parquet(files))
    run_sql_file(spark, f"{here}/sql/create_database.sql", database="ddl_files_db",
                 location=str(tmp_path / "ddl_files_db"))
    run_sql_file(spark, f"{here}/sql/create_table_policy.sql", database="ddl_files_db",
                 table_location=files)
    row = spark.table("ddl_files_db.policy").first()
    assert (row["policy_id"], row["month"], row["day"]) == (1, "02", "01")


def test_merge_dispatch_by_table_format(spark, lake):  # K2, K3 on formats with MERGE
    import pytest
    from daylake.plans.publish import merge_statement, table_format, upsert_table
    assert merge_statement("db.t", "src", ["a", "b"]) == (
        "MERGE INTO db.t AS target USING src AS delta ON target.a = delta.a AND "
        "target.b = delta.b WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
    table = _first(spark, lake, [(1, "a", "2024", "02", "01")])
    assert table_format(spark, table) == "parquet"
    spark.createDataFrame([(1, "b", "2024", "02", "01")], SCHEMA).createOrReplaceTempView("m_src")
    with pytest.raises(Exception):  # parquet has no MERGE: hence the partition rewrite
        spark.sql(merge_statement(table, "m_src", ["k"])).collect()
    stats = upsert_table(spark, table, spark.table("m_src"), ["k"])
    assert stats.rows_matched == 1 and _rows(spark, table) == [(1, "b", "01")]
