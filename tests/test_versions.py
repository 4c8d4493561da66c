"""Versions of a table: manifest, commits, types, key index, retention, and the
loads built on them (quarantine, headers, ledger, rebuild, log)."""
import datetime as dt
import itertools
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, NullType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

from daylake.functions.types import read_in_place, widest
from daylake.functions.mapping import raw_schema
from daylake.plans import key_index, manifest, publish
from daylake.plans.datasets import POLICY
from daylake.plans.jobs import bronze_to_gold, raw_to_bronze, rebuild_bronze, rejected_table
from daylake.plans.manifest import CommitConflict
from daylake.plans.publish import (apply_upsert, index_keys, plan_upsert, read_version, register_external, remove_orphans,
                                   restore_version, table_location, truncate, upsert_partitions, write_table)
from daylake.plans.report import read_log
from daylake.sources.ledger import read_ledger
from daylake.sources.landing import headers, scan_by_header, scan_files
from daylake.sources.tables import read_snapshot
from daylake.streaming import stream_to_bronze
from dataclasses import replace
from tests.conftest import HEADER, write_files

SCHEMA = "k long, v string, year string, month string, day string"
PARTS = ["year", "month", "day"]
TODAY = dt.date(2024, 2, 10)


def _ten_days(spark, lake, name="t"):
    table = f"{lake}.{name}"
    write_table(spark.range(100).select(
        F.col("id").alias("k"), F.lit("old").alias("v"), F.lit("2024").alias("year"), F.lit("02").alias("month"),
        F.format_string("%02d", F.col("id") % 10 + 1).alias("day")), table, PARTS)
    return table


def _rows(df):
    return sorted((r["k"] if r["k"] is not None else -1, r["v"], r["day"]) for r in df.collect())


def _all_ways(spark, table):
    """The rows by name, by path, at the version, and through a new registration."""
    root = table_location(spark, table)
    again = f"{table}_again"
    spark.sql(f"DROP TABLE IF EXISTS {again}")
    register_external(spark, again, None, root)
    found = [_rows(d) for d in (spark.table(table), read_snapshot(spark, root), read_version(spark, table),
                                spark.table(again))]
    assert found.count(found[0]) == 4
    return found[0]


# ---- one truth

def test_path_catalog_and_registration_agree(spark, lake):
    table = _ten_days(spark, lake)
    assert len(read_snapshot(spark, table_location(spark, table)).collect()) == 100     # no manifest yet
    for n in range(3):
        src = spark.createDataFrame([(3, f"n{n}", "2024", "02", f"{n + 1:02d}"), (500 + n, "new", "2024", "03", None)], SCHEMA)
        upsert_partitions(spark, table, src, ["k"])
        rows = _all_ways(spark, table)
        assert len(rows) == 101 + n and (3, f"n{n}", f"{n + 1:02d}") in rows
    assert read_snapshot(spark, table_location(spark, table), "k string, day string").dtypes == \
        [("k", "string"), ("day", "string")]


def test_typed_partitions_by_path(spark, lake):
    table = f"{lake}.typed"
    rows = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % 4 / 8).alias("share"),
                                  F.concat(F.lit("a b/%:"), (F.col("id") % 3).cast("string")).alias("day"))
    write_table(rows, table, ["share", "day"])
    upsert_partitions(spark, table, rows.where("k < 5").withColumn("v", F.lit("new")), ["k"])
    assert [v for _, v, _ in _all_ways(spark, table)] == ["new"] * 5 + ["old"] * 35


def test_empty_and_null_partitions_are_one(spark, lake):
    table = f"{lake}.void"
    write_table(spark.createDataFrame([(1, "a", "2024", "02", None), (2, "b", "2024", "02", "01"), (3, "c", "2024", "02", "")],
                                      SCHEMA), table, PARTS)
    upsert_partitions(spark, table, spark.createDataFrame([(4, "d", "2024", "02", ""), (2, "B", "2024", "02", None)], SCHEMA), ["k"])
    assert _all_ways(spark, table) == [(1, "a", None), (2, "B", None), (3, "c", None), (4, "d", None)]


def test_a_second_entry_over_the_folder_catches_up(spark, lake):
    table = _ten_days(spark, lake)
    upsert_partitions(spark, table, spark.createDataFrame([(1, "a", "2024", "02", "02")], SCHEMA), ["k"])
    root, other = table_location(spark, table), f"{lake}.other"
    register_external(spark, other, None, root)
    upsert_partitions(spark, table, spark.createDataFrame([(2, "b", "2024", "02", "11")], SCHEMA), ["k"])
    upsert_partitions(spark, other, spark.createDataFrame([(3, "c", "2024", "02", "11")], SCHEMA), ["k"])
    manifest.sync(spark, table, root, manifest.latest(spark, root))
    assert _rows(spark.table(other)) == _all_ways(spark, table)
    assert {v for _, v, _ in _rows(spark.table(table))} == {"a", "b", "c", "old"}


# ---- commits

def test_of_two_writers_one_plans_again(spark, lake):
    table = _ten_days(spark, lake)
    a = spark.createDataFrame([(k, "a", "2024", "02", "01") for k in range(0, 20)], SCHEMA)
    b = spark.createDataFrame([(k, "b", "2024", "02", "02") for k in range(10, 30)], SCHEMA)
    first, second = plan_upsert(spark, table, a, ["k"]), plan_upsert(spark, table, b, ["k"])
    apply_upsert(spark, second)
    with pytest.raises(CommitConflict):
        apply_upsert(spark, first)
    root = table_location(spark, table).removeprefix("file:")
    runs = [f for f in os.listdir(root) if f.startswith("daylake_run=")]
    assert len(runs) == 1       # what the loser wrote is gone
    assert upsert_partitions(spark, table, a, ["k"]).retries == 0
    assert _all_ways(spark, table) == sorted(
        [(k, "a", "01") for k in range(20)] + [(k, "b", "02") for k in range(20, 30)]
        + [(k, "old", f"{k % 10 + 1:02d}") for k in range(30, 100)])


def test_a_conflict_inside_the_upsert_is_tried_again(spark, lake, monkeypatch):
    table = _ten_days(spark, lake)
    mine = spark.createDataFrame([(1, "mine", "2024", "02", "01")], SCHEMA)
    theirs = spark.createDataFrame([(1, "theirs", "2024", "02", "05"), (2, "theirs", "2024", "02", "05")], SCHEMA)
    real, calls = publish.apply_upsert, []

    def slow(spark, plan, *args):
        if not calls:
            calls.append(1)
            monkeypatch.setattr(publish, "apply_upsert", real)
            upsert_partitions(spark, table, theirs, ["k"])
        return real(spark, plan, *args)
    monkeypatch.setattr(publish, "apply_upsert", slow)
    stats = upsert_partitions(spark, table, mine, ["k"])
    rows = _all_ways(spark, table)
    assert stats.retries == 1 and len(rows) == 100
    assert (1, "mine", "01") in rows and (2, "theirs", "05") in rows


def test_a_version_is_committed_once(spark, tmp_path):
    m = manifest.Manifest(1, StructType.fromDDL(SCHEMA), PARTS, {("2024", None, "01"): manifest.Entry("x", 3)})
    root = f"file:{tmp_path}"
    manifest.commit(spark, root, m)
    with pytest.raises(CommitConflict):
        manifest.commit(spark, root, m)
    assert manifest.latest(spark, root) == m
    assert [f for f in os.listdir(tmp_path / "_manifest") if f.startswith("draft")] == []
    for k in range(2, 30):
        manifest.commit(spark, root, replace(m, version=k))
    assert manifest.latest(spark, root).version == 29
    assert len([f for f in os.listdir(tmp_path / "_manifest") if f.endswith(".json")]) == manifest.KEPT_VERSIONS


def test_a_reader_of_a_version_keeps_it(spark, lake):
    table = _ten_days(spark, lake)
    upsert_partitions(spark, table, spark.createDataFrame([(1, "a", "2024", "02", "01")], SCHEMA), ["k"], retention_hours=1)
    reader = read_version(spark, table)
    before = _rows(reader)
    upsert_partitions(spark, table, spark.table(table).withColumn("v", F.lit("all")), ["k"], retention_hours=1)
    assert _rows(reader) == before
    assert {v for _, v, _ in _all_ways(spark, table)} == {"all"}
    # once the retention is over the next commit removes the old folders
    upsert_partitions(spark, table, spark.createDataFrame([(1, "b", "2024", "02", "01")], SCHEMA), ["k"])
    root = table_location(spark, table)
    assert manifest.latest(spark, root).rows == 100 and len(_all_ways(spark, table)) == 100
    assert not [f for _, _, names in os.walk(f"{root.removeprefix('file:')}/year=2024") for f in names]


def test_a_plan_changes_nothing(spark, lake):
    table = _ten_days(spark, lake)
    src = spark.createDataFrame([(1, "a", 5, "2024", "02", "01")], SCHEMA.replace("year", "extra int, year"))
    plan_upsert(spark, table, src, ["k"])
    assert spark.table(table).columns == ["k", "v", "year", "month", "day"]
    assert manifest.latest(spark, table_location(spark, table)) is None


@pytest.mark.parametrize("crash_at", range(5))
def test_a_crash_after_the_commit_is_completed(spark, lake, monkeypatch, crash_at):
    table = _ten_days(spark, lake)
    src = spark.createDataFrame([(k, "new", "2024", "02", "09") for k in (0, 1, 2, 10, 20)] + [(900, "new", "2024", "02", "30")], SCHEMA)
    done, real = [], type(spark).sql

    def failing(self, text, *args, **kw):
        if text.startswith("ALTER TABLE"):
            if len(done) == crash_at:
                raise RuntimeError("lost the driver")
            done.append(text)
        return real(self, text, *args, **kw)
    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        upsert_partitions(spark, table, src, ["k"])
    monkeypatch.undo()
    root = table_location(spark, table)
    want = sorted([(k, "new", "09") for k in (0, 1, 2, 10, 20)] + [(900, "new", "30")]
                  + [(k, "old", f"{k % 10 + 1:02d}") for k in range(100) if k not in (0, 1, 2, 10, 20)])
    assert _rows(read_snapshot(spark, root)) == want        # committed: all of it by path
    assert len(spark.table(table).select("k").distinct().collect()) >= 100
    manifest.sync(spark, table, root, manifest.latest(spark, root))
    assert _all_ways(spark, table) == want


# ---- types

KINDS = [ByteType(), ShortType(), IntegerType(), LongType(), FloatType(), DoubleType(), DecimalType(10, 2),
         DecimalType(38, 0), DateType(), TimestampType(), TimestampNTZType(), StringType(), NullType(),
         ArrayType(IntegerType()), ArrayType(LongType()), MapType(StringType(), IntegerType()),
         StructType([StructField("a", IntegerType())]), StructType([StructField("a", LongType())])]


def test_the_lattice():
    for a, b in itertools.product(KINDS, KINDS):
        w = widest(a, b)
        assert w == widest(b, a) and widest(a, a) == a
        if w is not None and not isinstance(w, (ArrayType, MapType, StructType)):
            assert widest(w, a) == w and widest(w, b) == w       # an upper bound
    assert widest(IntegerType(), LongType()) == LongType()
    assert widest(LongType(), DoubleType()) is None and widest(StringType(), IntegerType()) is None
    assert widest(TimestampType(), TimestampNTZType()) is None
    assert widest(IntegerType(), DecimalType(10, 2)) == DecimalType(12, 2)
    assert widest(LongType(), DecimalType(38, 30)) is None
    assert read_in_place(DateType(), TimestampNTZType()) and not read_in_place(DateType(), TimestampType())


@pytest.mark.parametrize("old,new,value", [
    ("int", "bigint", "5000000000"), ("tinyint", "int", "70000"), ("int", "double", "0.5"), ("float", "double", "0.1"),
    ("date", "timestamp", "2024-01-01 10:00:00"), ("date", "timestamp_ntz", "2024-01-01 10:00:00"),
    ("decimal(5,2)", "decimal(12,4)", "12345678.1234"), ("bigint", "decimal(30,2)", "1.25"),
    ("array<int>", "array<bigint>", None)])
def test_a_wider_source_widens_the_table(spark, lake, old, new, value):
    table = f"{lake}.wide"
    first = "2024-02-01" if old == "date" else "7"
    make = lambda text, kind: (F.array(F.lit(7).cast(kind[6:-1])) if kind.startswith("array") else
                               F.lit(text).cast(kind))
    write_table(spark.range(20).select(F.col("id").alias("k"), make(first, old).alias("x"),
                                       (F.col("id") % 4).cast("string").alias("day")), table, ["day"])
    src = spark.createDataFrame([(1, "1"), (50, "9")], "k long, day string").withColumn("x", make(value, new)).select("k", "x", "day")
    upsert_partitions(spark, table, src, ["k"])
    assert dict(spark.table(table).dtypes)["x"] == new
    for df in (spark.table(table), read_snapshot(spark, table_location(spark, table))):
        got = {r.k: r.x for r in df.collect()}
        same = spark.range(1).select(make(first, old).cast(new).alias("a"), make(value, new).alias("b")).first()
        assert got == {k: same.a for k in range(20)} | {1: same.b, 50: same.b}
    # narrower values go in as the table's type
    upsert_partitions(spark, table, src.where("k = 50").withColumn("x", make(first, old)), ["k"])
    assert {r.k: r.x for r in spark.table(table).collect()}[50] == same.a and dict(spark.table(table).dtypes)["x"] == new


@pytest.mark.parametrize("old,new", [("int", "string"), ("bigint", "double"), ("timestamp", "string"), ("string", "int")])
def test_types_without_a_common_one_are_refused(spark, lake, old, new):
    table = f"{lake}.kept"
    write_table(spark.range(5).select(F.col("id").alias("k"), F.lit(None).cast(old).alias("x"), F.lit("1").alias("day")),
                table, ["day"])
    before = sorted(os.listdir(table_location(spark, table).removeprefix("file:")))
    src = spark.range(9).select(F.col("id").alias("k"), F.lit(None).cast(new).alias("x"), F.lit("1").alias("day"))
    with pytest.raises(ValueError, match="column x"):
        upsert_partitions(spark, table, src, ["k"])
    assert spark.table(table).count() == 5
    assert sorted(os.listdir(table_location(spark, table).removeprefix("file:"))) == before
    with pytest.raises(ValueError, match="column day"):
        upsert_partitions(spark, table, src.withColumns({"x": F.lit(None).cast(old), "day": F.lit(1)}), ["k"])


# ---- key index

def test_bloom_has_no_false_negatives():
    rng = np.random.default_rng(1)
    held = rng.integers(-2**63, 2**63 - 1, 5000)
    filter_ = key_index.bloom(held)
    assert all(key_index.may_hold(filter_, held[k:k + 1]) for k in range(0, 5000, 50))
    others = rng.integers(-2**63, 2**63 - 1, 20000)
    assert not any(key_index.may_hold(filter_, others[k:k + 1]) for k in range(0, 20000, 20))
    assert key_index.may_hold(filter_, np.concatenate((others, held[:1])))
    assert not key_index.may_hold(key_index.bloom(np.zeros(0, np.int64)), others)


def _indexed(spark, lake, keys=("k",)):
    table = _ten_days(spark, lake, "indexed")
    index_keys(spark, table, list(keys))
    return table


def test_the_index_leaves_few_partitions_to_read(spark, lake):
    table, plain = _indexed(spark, lake), _ten_days(spark, lake, "plain")
    for n, keys in enumerate([[13, 23], [14], [13, 1000], [2000], list(range(5, 60, 10))]):
        src = spark.createDataFrame([(k, f"n{n}", "2024", "02", f"{n + 11}") for k in keys], SCHEMA)
        plan = plan_upsert(spark, table, src, ["k"])
        days = {r.day for r in spark.table(table).where(F.col("k").isin(keys)).collect()}
        assert plan.stats.partitions_read == len(days)
        a, b = apply_upsert(spark, plan), upsert_partitions(spark, plain, src, ["k"])
        assert (a.rows_before, a.rows_matched, a.rows_after) == (b.rows_before, b.rows_matched, b.rows_after)
        assert _all_ways(spark, table) == _rows(spark.table(plain))


def test_the_index_by_range_alone(spark, lake, monkeypatch):
    table = f"{lake}.ranges"
    write_table(spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit("2024").alias("year"),
                                        F.lit("02").alias("month"),
                                        F.format_string("%02d", (F.col("id") / 10).cast("int")).alias("day")), table, PARTS)
    monkeypatch.setattr(key_index, "MAX_KEYS", 0)        # no filters
    index_keys(spark, table, ["k"])
    src = spark.createDataFrame([(k, "new", "2024", "02", "20") for k in (33, 48)], SCHEMA)
    stats = upsert_partitions(spark, table, src, ["k"])
    assert stats.partitions_read == 2 and stats.rows_matched == 2 and stats.rows_after == 100


def _strided(spark, lake, name, rows=400):
    """Four days; each holds every fourth key, so that all ranges overlap."""
    table = f"{lake}.{name}"
    write_table(spark.range(rows).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit("2024").alias("year"),
                                         F.lit("02").alias("month"),
                                         F.format_string("%02d", (F.col("id") % 4).cast("int")).alias("day")), table, PARTS)
    return table


def _index_rows(spark, table, rows=None):
    """The index's rows; ``rows`` replace them."""
    root = f"{table_location(spark, table)}/{key_index.FOLDER}"
    if rows is None:
        return spark.read.option("recursiveFileLookup", "true").parquet(root)
    rows = rows.localCheckpoint()
    key_index.remove_folder(spark, root)
    rows.write.parquet(f"{root}/all-again")


def _days_read(spark, table, keys):
    src = spark.createDataFrame([(k, "new", "2024", "02", "09") for k in keys], SCHEMA)
    return plan_upsert(spark, table, src, ["k"]).stats.partitions_read


def test_a_large_partition_has_several_bounded_filters(spark, lake, monkeypatch):
    monkeypatch.setattr(key_index, "MAX_KEYS", 8)
    monkeypatch.setattr(key_index, "TASK_KEYS", 50, raising=False)
    table = _strided(spark, lake, "several")
    index_keys(spark, table, ["k"])
    assert [_days_read(spark, table, keys) for keys in ([41], [378], [41, 45, 399], [40, 41, 42, 43])] == [1, 1, 2, 4]
    index = _index_rows(spark, table)
    sizes = index.groupBy("folder").agg(F.count("filter").alias("n"), F.first("parts").alias("parts"),
                                        F.max(F.length("filter")).alias("bytes")).collect()
    assert [(r.n, r.parts, r.bytes) for r in sizes] == [(13, 13, 31)] * 4
    # a folder that lacks a filter's row is judged by its range
    _index_rows(spark, table, index.where(~((F.col("part") == 3) & F.col("folder").endswith("day=00"))))
    assert [_days_read(spark, table, keys) for keys in ([41], [40], [42, 43])] == [2, 1, 3]


def test_an_index_of_one_filter_a_folder_is_still_asked(spark, lake):
    table = _strided(spark, lake, "former")
    index_keys(spark, table, ["k"])
    _index_rows(spark, table, _index_rows(spark, table).drop("part", "parts"))
    assert [_days_read(spark, table, keys) for keys in ([41], [41, 45, 399], [40, 41, 42, 43])] == [1, 2, 4]


def test_filters_of_a_task_hold_their_own_hashes():
    rng = np.random.default_rng(2)
    hashes = {s: rng.integers(-2**63, 2**63 - 1, n) for s, n in ((7, 300), (9, 1), (2**40, 4000), (3, 0))}
    rows = [(s, 8 * max(8, 4 * len(h)), None if k < 0 else int(h[k])) for s, h in hashes.items() for k in range(-1, len(h))]
    rows = [rows[k] for k in rng.permutation(len(rows))] + [rows[1]] * 500
    schema = pa.schema([("slot", pa.int64()), ("bits", pa.int64()), ("h", pa.int64())])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[k:k + 700]], schema)
               for k in range(0, len(rows), 700)]
    assert not any(b.num_rows for b in key_index.blooms(iter([])))
    out = [(r["slot"], r["filter"]) for b in key_index.blooms(iter(batches)) for r in b.to_pylist()]
    assert len(out) == 4 and {s: f for s, f in out} == {s: key_index.bloom(h) for s, h in hashes.items()}


def test_counts_per_partition_sort_files_not_rows(spark, lake):
    table = _strided(spark, lake, "counted")
    df = manifest._per_folder(spark.table(table), PARTS)
    scan = df._jdf.queryExecution().executedPlan().toString().rpartition("Exchange")[2]
    assert "HashAggregate" in scan and "Sort" not in scan
    m = manifest.from_catalog(spark, table, table_location(spark, table), PARTS)
    assert {n[-1]: (e.folder, e.rows) for n, e in m.entries.items()} == {
        f"0{d}": (f"year=2024/month=02/day=0{d}", 100) for d in range(4)}


def test_null_keys_and_wider_keys_with_an_index(spark, lake):
    table = f"{lake}.nulls"
    schema = SCHEMA.replace("k long", "k int")
    write_table(spark.createDataFrame([(1, "f1", "2024", "02", "01"), (None, "f1", "2024", "02", "02"),
                                       (3, "f3", "2024", "02", "03")], schema), table, PARTS)
    index_keys(spark, table, ["k"])
    again = spark.createDataFrame([(None, "f1", "2024", "02", "04")], schema)
    stats = upsert_partitions(spark, table, again, ["k"], replay_by=["v"])
    assert (stats.partitions_read, stats.rows_matched) == (1, 1)
    assert _all_ways(spark, table) == [(-1, "f1", "04"), (1, "f1", "01"), (3, "f3", "03")]
    # a long hashes differently from an int: index rows of the old type are not asked
    wide = spark.createDataFrame([(3, "w", "2024", "02", "05"), (2**40, "w", "2024", "02", "05")], SCHEMA)
    assert upsert_partitions(spark, table, wide, ["k"]).rows_matched == 1
    assert upsert_partitions(spark, table, wide.withColumn("v", F.lit("x")), ["k"]).rows_matched == 2
    assert [v for _, v, _ in _all_ways(spark, table)] == ["f1", "f1", "x", "x"]


# ---- retention

def test_orphans_go_and_nothing_else(spark, lake):
    table = _ten_days(spark, lake)
    upsert_partitions(spark, table, spark.createDataFrame([(1, "a", "2024", "02", "01")], SCHEMA), ["k"], retention_hours=1)
    root = table_location(spark, table).removeprefix("file:")
    before = _all_ways(spark, table)
    spark.table(table).write.partitionBy(*PARTS).parquet(f"{root}/daylake_run=dead")
    os.makedirs(f"{root}/daylake_run=early/_temporary/0")
    open(f"{root}/daylake_run=early/_temporary/0/part-0.parquet", "w").close()
    assert remove_orphans(spark, table) == [] and os.path.isdir(f"{root}/daylake_run=dead")     # young
    gone = remove_orphans(spark, table, older_than_hours=0)
    assert len(gone) == 10 and all(g.startswith("daylake_run=dead/") for g in gone)
    assert not os.path.exists(f"{root}/daylake_run=dead") and not os.path.exists(f"{root}/daylake_run=early")
    assert os.path.isdir(f"{root}/year=2024/month=02/day=01")       # superseded, but within its retention
    assert _all_ways(spark, table) == before


def test_truncate_and_restore(spark, lake):
    table = _ten_days(spark, lake)
    src = spark.createDataFrame([(1, "a", "2024", "02", "01")], SCHEMA)
    upsert_partitions(spark, table, src, ["k"], retention_hours=1)
    before = _all_ways(spark, table)
    truncate(spark, table, retention_hours=1)
    assert _all_ways(spark, table) == []
    restore_version(spark, table, 1)
    assert _all_ways(spark, table) == before
    truncate(spark, table)
    assert _all_ways(spark, table) == []
    with pytest.raises(ValueError, match="lost"):
        restore_version(spark, table, 1)
    upsert_partitions(spark, table, src, ["k"])
    assert _all_ways(spark, table) == [(1, "a", "01")]


# ---- loads

LINE = "U,{0},2024-12-31,Urban,NY,East,{1},Retail,N,N"


def test_quarantine_splits_one_scan(spark, tmp_path, lake):
    root, table = str(tmp_path / "land"), f"{lake}.b"
    write_files(root, {"full-load/p_20240201.csv": [LINE.format(1, 1), "I,x,2024-12-31,U,N,E,abc,R,N,N", "I,,2024-12-31,U,N,E,1,R,N,N",
                                                    "I,5,2024-12-31,U", LINE.format(1, 2)]})
    careful = replace(POLICY, quarantine=True)
    r = raw_to_bronze(spark, careful, root, table, today=TODAY).first()
    assert (r.qtty_source, r.rows_quarantined, r.rows_dropped, r.qtty_after, r.null_keys) == (5, 3, 1, 1, 2)
    bad = {tuple((p.reason, p.column, p.value) for p in x.problems)
           for x in spark.table(rejected_table(table)).collect()}
    assert bad == {(("bad value", "policy_id", "x"), ("bad value", "insured_value", "abc")), (("no key", "policy_id", None),),
                   (("corrupt line", None, "I,5,2024-12-31,U"),)}
    write_files(root, {"cdc-load/p_20240202.csv": [LINE.format(2, 1), "I,y,2024-12-31,U,N,E,1,R,N,N"]})
    for _ in range(2):      # a replay replaces the file's rejected rows
        r = raw_to_bronze(spark, careful, root, table, today=TODAY).first()
        assert (r.qtty_source, r.rows_quarantined, r.rows_dropped, r.qtty_after) == (2, 1, 0, 2)
        assert spark.table(rejected_table(table)).count() == 4
    write_files(root, {"cdc-load/p_20240202.csv": [LINE.format(2, 1)]})
    assert raw_to_bronze(spark, careful, root, table, today=TODAY).first()["rows_quarantined"] == 0


def test_columns_bind_by_the_header(spark, tmp_path, lake):
    root = str(tmp_path / "land")
    names = HEADER.split(",")
    line = dict(zip(names, LINE.format(7, 1).split(",")))
    folder = f"{root}/full-load"
    os.makedirs(folder)
    for day, order in (("01", names), ("02", names[::-1]), ("03", [*names[:4], "extra", *names[4:8]])):
        head = ",".join(n.upper() if day == "02" else n for n in order)
        text = ",".join({**line, "extra": "?", "policy_id": f"1{day}"}.get(n) for n in order)
        with open(f"{folder}/p_202402{day}.csv", "w", encoding="utf-8-sig" if day == "03" else "utf-8") as fh:
            fh.write(f"{head}\n{text}\n")
    raw_to_bronze(spark, replace(POLICY, bind_by_header=True), root, f"{lake}.b", today=TODAY)
    got = sorted((r.policy_id, r.location_name, r.insured_value, r.flood) for r in spark.table(f"{lake}.b").collect())
    assert got == [(101, "Urban", 1.0, "N"), (102, "Urban", 1.0, "N"), (103, "Urban", 1.0, None)]
    schema = raw_schema(names)
    assert len(headers(spark, [f"{folder}/p_202402{d}.csv" for d in ("01", "02", "03")])) == 3
    for bad in ("a,b,c", "policy_id,x,Policy_Id"):
        with open(f"{folder}/p_20240204.csv", "w") as fh:
            fh.write(f"{bad}\n1,2,3\n")
        with pytest.raises(ValueError, match="p_20240204"):
            scan_by_header(spark, folder, schema, required=["policy_id"])
    assert scan_by_header(spark, folder, schema, "2030-01-01").count() == 0
    assert scan_files(spark, [], schema).columns == scan_by_header(spark, folder, schema, "2024-02-01", "2024-02-02").columns


def test_late_files_load_once(spark, tmp_path, lake):
    root, table = str(tmp_path / "land"), f"{lake}.b"
    load = lambda: raw_to_bronze(spark, POLICY, root, table, today=TODAY, ledger=True).first()
    rows = lambda: sorted((r.policy_id, r.insured_value) for r in spark.table(table).collect())
    write_files(root, {"full-load/p_20240201.csv": [LINE.format(1, 1)],
                       "cdc-load/p_20240204.csv": [LINE.format(1, 4), LINE.format(2, 4)]})
    load()
    assert load()["qtty_source"] == 2 and load()["qtty_source"] == 0
    write_files(root, {"cdc-load/p_20240203.csv": [LINE.format(1, 3), LINE.format(3, 3)]})      # late, and older
    assert load()["qtty_source"] == 2
    assert rows() == [(1, 4.0), (2, 4.0), (3, 3.0)]
    write_files(root, {"cdc-load/p_20240204.csv": [LINE.format(2, 40)]})        # replaced in place
    assert load()["qtty_source"] == 1 and load()["qtty_source"] == 0
    assert rows() == [(1, 4.0), (2, 40.0), (3, 3.0)]
    book = read_ledger(spark, f"{table_location(spark, table)}/_files")
    assert book.count() == 3 and book.select("path").distinct().count() == 2


def test_a_target_that_holds_a_key_twice_multiplies_nothing(spark, tmp_path, lake):
    from daylake.plans.jobs import _newer_than_table
    target = spark.createDataFrame([(1, "20240201"), (1, "20240203")], "policy_id long, year_month_day string")
    source = spark.createDataFrame([(1, "20240202"), (1, "20240204"), (2, "20240101")], "policy_id long, year_month_day string")
    got = sorted(map(tuple, _newer_than_table(target, source, POLICY).collect()))
    assert got == [(1, "20240204"), (2, "20240101")]


def test_rebuild_and_restore(spark, policy_landing, lake):
    table, clean = f"{lake}.b", f"{lake}.clean"
    value = lambda t: sorted((r.policy_id or -1, r.insured_value, r.year_month_day) for r in spark.table(t).collect())
    for _ in range(2):
        raw_to_bronze(spark, POLICY, policy_landing, clean, today=TODAY)
    raw_to_bronze(spark, POLICY, policy_landing, table, today=TODAY)
    wrong = \
        spark.createDataFrame(spark.table(table).withColumn("insured_value", F.lit(0.0)).collect(), spark.table(table).schema)
    upsert_partitions(spark, table, wrong, ["policy_id"])
    spoiled = value(table)
    r = rebuild_bronze(spark, POLICY, policy_landing, table, today=TODAY).first()
    assert (r.load_kind, r.qtty_before, r.qtty_after) == ("rebuild", 2, len(value(clean)))
    # rows without a key: one per load, so one here where the clean loads are one scan each
    assert value(table) == value(clean) != spoiled
    restore_version(spark, table, 1)
    assert value(table) == spoiled
    restore_version(spark, table, 2)
    assert value(table) == value(clean)


def test_batch_and_stream_write_one_log(spark, policy_landing, lake, tmp_path):
    log = str(tmp_path / "log")
    assert read_log(spark, log).count() == 0
    for t in ("a", "b"):
        raw_to_bronze(spark, POLICY, policy_landing, f"{lake}.{t}", today=TODAY)
    raw_to_bronze(spark, POLICY, policy_landing, f"{lake}.a", today=TODAY, log=log)
    stream_to_bronze(spark, POLICY, policy_landing, f"{lake}.b", str(tmp_path / "c"), log=log).awaitTermination(300)
    bronze_to_gold(spark, POLICY, f"{lake}.a", f"{lake}.g", today=TODAY, log=log)
    counts = ["load_kind", "qtty_before", "qtty_source", "qtty_after", "null_keys", "bad_values", "rows_dropped",
              "rows_quarantined", "corrupt_lines", "files_undated"]
    rows = {r.stage: [r[c] for c in counts] for r in read_log(spark, log).collect()}
    assert set(rows) == {"bronze", "stream", "gold"} and rows["bronze"] == rows["stream"]
    assert rows["stream"][-1] == 1
