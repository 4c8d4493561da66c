import os

import pytest
from pyspark.sql import functions as F

from daylake.functions.mapping import RAW_POLICY, raw_schema
from daylake.plans.landed import write_dated_csv
from daylake.sources.landing import RFC4180, file_counts, read_csv, scan_dated
from tests.conftest import write_files

SCHEMA = raw_schema(RAW_POLICY)


def _ids(df):
    return sorted((r["policy_id"] or "", r["year_month_day"]) for r in df.collect())


def test_window_both_ends_included(spark, policy_landing):  # S1, F3
    cdc = f"{policy_landing}/cdc-load"
    assert {r[1] for r in _ids(scan_dated(spark, cdc, SCHEMA, "2024-02-02", "2024-02-03"))} \
        == {"20240202", "20240203"}
    only = _ids(scan_dated(spark, cdc, SCHEMA, "20240203", "20240203"))
    assert only == [("1", "20240203"), ("2", "20240203")]
    assert scan_dated(spark, cdc, SCHEMA, "2024-02-04", None).count() == 0


def test_undated_and_other_suffix_skipped(spark, policy_landing):  # S1, F4
    ids = [r[0] for r in _ids(scan_dated(spark, f"{policy_landing}/cdc-load", SCHEMA))]
    assert "9" not in ids and "8" not in ids
    assert len(ids) == 7


def test_window_prunes_files(spark, policy_landing):  # S1 on _metadata
    df = scan_dated(spark, f"{policy_landing}/cdc-load", SCHEMA, "2024-02-03", "2024-02-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "file_name" in plan
    df.collect()


def test_missing_root_raises_and_an_empty_one_is_empty(spark, tmp_path, policy_landing):  # R2 / S1
    (tmp_path / "empty").mkdir()
    df = scan_dated(spark, str(tmp_path / "empty"), SCHEMA)
    assert df.count() == 0
    assert df.columns == RAW_POLICY + ["_corrupt_line", "file_name", "year_month_day"]
    with pytest.raises(FileNotFoundError, match="nothing"):
        scan_dated(spark, [f"{policy_landing}/cdc-load", str(tmp_path / "nothing")], SCHEMA)


def test_files_and_lines_left_out_are_counted(spark, tmp_path, policy_landing):
    cdc = f"{policy_landing}/cdc-load"
    assert file_counts(spark, cdc, "20240203") == {"files_read": 1, "files_outside": 1, "files_undated": 1}
    assert file_counts(spark, cdc) == {"files_read": 2, "files_outside": 0, "files_undated": 1}
    with open(f"{cdc}/policy_20001231.csv", "w") as fh:  # long ago, still in an open window
        fh.write(",".join(RAW_POLICY) + "\nI,7,2024-12-31,Urban\nI,8,2024-12-31,Urban,NY,East,1,Retail,N,N\n")
    df = scan_dated(spark, cdc, SCHEMA, final="2001-01-01")
    assert [r["_corrupt_line"] is None for r in sorted(df.collect(), key=lambda r: r["policy_id"])] == [False, True]


def test_rows_without_a_day_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, "20240101"), (2, None)], "id long, d string")
    with pytest.raises(Exception, match="row without d"):
        write_dated_csv(rows, str(tmp_path / "x"), "d").collect()


def test_default_quoting_is_the_backslash(spark, tmp_path):
    path = tmp_path / "q"
    path.mkdir()
    (path / "a_20240101.csv").write_text('id,v\n1,"x\\"y"\n')
    assert scan_dated(spark, str(path), raw_schema(["id", "v"])).first()["v"] == 'x"y'


def test_lineage_is_file_path(spark, policy_landing):  # P3, P4
    df = scan_dated(spark, f"{policy_landing}/full-load", SCHEMA)
    names = {r["file_name"] for r in df.collect()}
    assert len(names) == 1 and names.pop().endswith("/full-load/policy_20240201.csv")
    # still right after a shuffle (input_file_name() would be empty there)
    shuffled = df.repartition(3).select("file_name").distinct().collect()
    assert shuffled[0][0].endswith("policy_20240201.csv")


def test_header_binds_by_position_strict_fails(spark, tmp_path):  # S2, D8
    root = str(tmp_path / "swap")
    os.makedirs(root)
    with open(f"{root}/p_20240201.csv", "w") as fh:
        fh.write("policy_id,operation\n5,I\n")
    schema = raw_schema(["operation", "policy_id"])
    row = read_csv(spark, root, schema).first()
    assert (row["operation"], row["policy_id"]) == ("5", "I")
    with pytest.raises(Exception):
        read_csv(spark, root, schema, strict=True).collect()


def test_write_dated_csv_roundtrip(spark, tmp_path):
    root = str(tmp_path / "land")
    df = spark.createDataFrame(
        [(1, '{"k": "a,b"}', "20240101", "full-load"), (2, None, "20240101", "full-load"),
         (3, 'say "hi"', "20240102", "cdc-load"), (4, "x", "20240102", "cdc-load")],
        "id long, props string, d string, folder string").repartition(2)
    files = write_dated_csv(df, root, "d", "folder", prefix="t").collect()
    assert sum(r["rows"] for r in files) == 4
    assert all(os.path.basename(r["path"])[-12:-4] in ("20240101", "20240102") for r in files)
    back = scan_dated(spark, root, raw_schema(["id", "props"]), options=RFC4180).orderBy(F.col("id").cast("int"))
    got = [(r["id"], r["props"], r["year_month_day"]) for r in back.collect()]
    assert got == [("1", '{"k": "a,b"}', "20240101"), ("2", None, "20240101"),
                   ("3", 'say "hi"', "20240102"), ("4", "x", "20240102")]
    # no hidden attempt files are left behind
    leftovers = [f for _, _, fs in os.walk(root) for f in fs if f.startswith(".")]
    assert leftovers == []


def test_landing_fixture_files(spark, tmp_path):
    root = str(tmp_path / "l")
    write_files(root, {"cdc-load/a_20240105.csv": ["I,1,,,,,,,,"]})
    assert scan_dated(spark, root, SCHEMA).count() == 1
