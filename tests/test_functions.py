import datetime as dt

import pytest
from pyspark.sql import functions as F

from daylake.functions.dates import resolve_day, resolve_window, split_day, to_compact
from daylake.functions.mapping import (BRONZE_POLICY, GOLD_POLICY, Field, apply_mapping,
                                       cast_failures)
from daylake.functions.naming import snake_case, snake_case_columns

TODAY = dt.date(2024, 2, 4)


def test_window_defaults_and_cron():  # F5, S1 defaults
    assert resolve_window(None, None, today=TODAY) == (None, None)
    assert resolve_window(None, "cron", today=TODAY) == (None, "2024-02-03")
    assert resolve_window("cron", "cron", today=TODAY) == ("2024-02-03", "2024-02-03")
    assert resolve_window("2024-02-01", "cron", today=TODAY) == ("2024-02-01", "2024-02-01")
    assert resolve_window("cron", "2024-02-10", today=TODAY) == ("2024-02-03", "2024-02-10")
    assert resolve_window("x", "y", reprocess_all=True, today=TODAY) == (None, "2024-02-04")


def test_window_accepts_both_forms_strictly():  # F6, D11
    assert resolve_window("20240201", "2024-02-03", today=TODAY) == ("2024-02-01", "2024-02-03")
    for bad in ("02/03/2024", "2024-2-3", "2024-02-30", "yesterday"):
        with pytest.raises(ValueError):
            resolve_window(bad, None, today=TODAY)


def test_resolve_day():  # F6
    assert resolve_day("cron", today=TODAY) == "20240203"
    assert resolve_day("", today=TODAY) == "20240203"
    assert resolve_day(None, today=TODAY) == "20240203"
    assert resolve_day("2024-02-01", today=TODAY) == "20240201"
    assert split_day("20240203") == ("2024", "02", "03")
    assert to_compact("2024-02-03") == "20240203"


@pytest.mark.parametrize("name,expected", [
    ("PolicyId", "policy_id"), ("HTMLPage", "html_page"), ("Policy_Id", "policy__id"),
    ("PolicyID", "policy_id"), ("ABCdef", "ab_cdef"), ("aB", "a_b"),
    ("Insured-Value", "insured_value"), ("policy_id", "policy_id"),
    ("Address2Line", "address2_line"), ("two words", "two_words"),
])
def test_snake_case(name, expected):  # P10
    assert snake_case(name) == expected


def test_snake_case_columns_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "PolicyId long, policy_id long")
    with pytest.raises(ValueError):
        snake_case_columns(df)
    ok = snake_case_columns(spark.createDataFrame([(1, 2)], "PolicyId long, HTMLPage long"))
    assert ok.columns == ["policy_id", "html_page"]


def test_mapping_try_cast_and_failure_counts(spark):  # P1, D9
    raw = spark.createDataFrame(
        [("1", "2024-12-31", "100.5", "N"), ("x", "02/03/2024", "abc", "Yes"),
         (" 7 ", None, "1.0", None), ("1.0", "2024-01-01", "5", "N")],
        "policy_id string, expiry_date string, insured_value string, earthquake string")
    mapping = [Field("policy_id", "policy_id", "bigint"),
               Field("expiry_date", "expiry_date", "date"),
               Field("insured_value", "insured_value", "double"),
               Field("earthquake", "earth_quake", "string")]
    out = apply_mapping(raw, mapping)
    assert out.schema.simpleString() == ("struct<policy_id:bigint,expiry_date:date,"
                                        "insured_value:double,earth_quake:string>")
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == (1, dt.date(2024, 12, 31), 100.5, "N")
    assert rows[1] == (None, None, None, "Yes")      # flag longer than one char is kept
    assert rows[2][0] == 7 and rows[2][2] == 1.0     # ' 7 ' -> 7
    assert rows[3][0] is None                        # '1.0' is not a bigint
    bad = raw.agg(*cast_failures(mapping)).first().asDict()
    assert bad == {"bad_policy_id": 2, "bad_expiry_date": 1, "bad_insured_value": 1}


def test_policy_mappings_shape():  # P1, P2
    assert [f.target for f in BRONZE_POLICY][-2:] == ["earth_quake", "flood"]
    gold = [f.target for f in GOLD_POLICY]
    assert "earth_quake" not in gold and len(gold) == 13
    assert gold[-4:] == ["year_month_day", "year", "month", "day"]


def test_date_parts(spark):  # P5
    from daylake.functions.lineage import name_date, with_date_parts
    df = spark.createDataFrame([("s3://b/x/policy_20240203.csv",), ("a/nodate.csv",)], "f string")
    out = with_date_parts(df.withColumn("year_month_day", name_date(F.col("f")))).collect()
    assert tuple(out[0])[1:] == ("20240203", "2024", "02", "03")
    assert out[1]["year_month_day"] == ""
