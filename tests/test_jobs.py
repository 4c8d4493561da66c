import datetime as dt

from daylake.plans.datasets import POLICY
from daylake.plans.jobs import bronze_to_gold, earliest_day, raw_to_bronze
from tests.conftest import FILES, write_files

TODAY = dt.date(2024, 2, 4)


def _bronze(spark, table):
    return {(r["policy_id"] if r["policy_id"] is not None else -1): (r["insured_value"], r["year_month_day"])
            for r in spark.table(table).collect()}


def _report(df):
    r = df.first()
    return r["load_kind"], r["qtty_before"], r["qtty_source"], r["qtty_after"]


def test_policy_chain(spark, policy_landing, lake):  # S4, K1, K2, D4, D5, D9, D12, D14, §7.3
    bronze = f"{lake}.policy"
    r1 = raw_to_bronze(spark, POLICY, policy_landing, bronze, reprocess_all=True, today=TODAY)
    assert _report(r1) == ("first", 0, 2, 2)
    assert spark.table(bronze).columns == [
        "policy_id", "expiry_date", "location_name", "state_code", "region_name",
        "insured_value", "business_type", "earth_quake", "flood", "file_name",
        "year_month_day", "year", "month", "day"]

    r2 = raw_to_bronze(spark, POLICY, policy_landing, bronze, "2024-02-02", "cron", today=TODAY)
    row = r2.first()
    assert (row["load_kind"], row["qtty_before"], row["qtty_source"], row["qtty_after"]) == ("upsert", 2, 5, 4)
    # keys "x" and "": both NULL before the dedup; bad: x, 02/03/2024, abc
    assert row["null_keys"] == 2 and row["bad_values"] == 3 and row["corrupt_lines"] == 0
    assert row["rows_dropped"] == 2 and (row["files_outside"], row["files_undated"]) == (1, 1)
    # day 01 (policy 1 matched) and day 02 (new rows) rewritten, none dropped
    assert (row["partitions_rewritten"], row["partitions_dropped"], row["keys_broadcast"]) == (2, 0, True)
    assert _bronze(spark, bronze) == {1: (101.5, "20240202"), 2: (200.0, "20240201"),
                                      3: (301.0, "20240202"), -1: (5.0, "20240202")}

    r3 = raw_to_bronze(spark, POLICY, policy_landing, bronze, "cron", "cron", today=TODAY)
    assert _report(r3) == ("upsert", 4, 2, 4)
    # policy 2 marked 'D' stays live (D12); day 01 lost all its rows and is gone
    assert _bronze(spark, bronze) == {1: (102.5, "20240203"), 2: (200.0, "20240203"),
                                      3: (301.0, "20240202"), -1: (5.0, "20240202")}
    assert earliest_day(spark, bronze) == "20240202"

    gold = f"{lake}.policy_prod"
    g1 = bronze_to_gold(spark, POLICY, bronze, gold, initial="first", today=TODAY)
    assert _report(g1) == ("first", 0, 2, 2)  # earliest day only (D3, D17)
    assert g1.first()["null_keys"] == 1 and g1.first()["rows_unpublished"] == 2
    assert "earth_quake" not in spark.table(gold).columns
    assert len(spark.table(gold).columns) == 13
    g2 = bronze_to_gold(spark, POLICY, bronze, gold, day="cron", today=TODAY)
    assert _report(g2) == ("upsert", 2, 2, 4)
    got = sorted((r["policy_id"] or -1, r["day"]) for r in spark.table(gold).collect())
    assert got == [(-1, "02"), (1, "03"), (2, "03"), (3, "02")]

    # the same day again changes nothing in gold
    bronze_to_gold(spark, POLICY, bronze, gold, day="20240203", today=TODAY)
    assert spark.table(gold).count() == 4


def test_older_file_later_wins_and_a_replay_adds_nothing(spark, tmp_path, lake):  # D13, D14
    root = str(tmp_path / "land2")
    files = {"full-load/policy_20240203.csv": FILES["cdc-load/policy_20240203.csv"],
             "cdc-load/policy_20240202.csv": FILES["cdc-load/policy_20240202.csv"]}
    write_files(root, files)
    bronze = f"{lake}.p2"
    raw_to_bronze(spark, POLICY, root, bronze, today=TODAY)
    raw_to_bronze(spark, POLICY, root, bronze, today=TODAY)
    assert _bronze(spark, bronze)[1] == (101.5, "20240202")
    raw_to_bronze(spark, POLICY, root, bronze, today=TODAY)
    # the same file again: its NULL-key row is replaced, not added once more
    assert spark.table(bronze).where("policy_id is null").count() == 1
    gold = f"{lake}.g2"
    for _ in range(3):
        bronze_to_gold(spark, POLICY, bronze, gold, day="all", today=TODAY)
        assert spark.table(gold).where("policy_id is null").count() == 1
    # another file's NULL-key row stays beside it
    write_files(root, {"cdc-load/policy_20240205.csv": ["I,,2024-01-01,Rural,TX,South,6,Farm,N,N"]})
    raw_to_bronze(spark, POLICY, root, bronze, today=TODAY)
    assert spark.table(bronze).where("policy_id is null").count() == 2


def test_empty_window_changes_nothing(spark, policy_landing, lake):  # R2
    bronze = f"{lake}.p3"
    r = raw_to_bronze(spark, POLICY, policy_landing, bronze, "2030-01-01", "2030-01-02", today=TODAY)
    assert _report(r) == ("none", 0, 0, 0)
    from daylake.sources.tables import table_exists
    assert not table_exists(spark, bronze)


def test_gold_list_of_days_and_initial_all(spark, policy_landing, lake):  # D18, D3 option
    bronze = f"{lake}.pb"
    raw_to_bronze(spark, POLICY, policy_landing, bronze, today=TODAY)
    raw_to_bronze(spark, POLICY, policy_landing, bronze, "2024-02-02", "2024-02-02", today=TODAY)
    gold_all = f"{lake}.g_all"
    r = bronze_to_gold(spark, POLICY, bronze, gold_all, initial="all", today=TODAY)
    assert _report(r) == ("first", 0, 4, 4)
    gold = f"{lake}.g_days"
    bronze_to_gold(spark, POLICY, bronze, gold, initial="first", today=TODAY)  # earliest: 20240201
    assert sorted(r["policy_id"] for r in spark.table(gold).collect()) == [2]
    r = bronze_to_gold(spark, POLICY, bronze, gold, day=["20240201", "20240202"], today=TODAY)
    assert _report(r)[0] == "upsert" and spark.table(gold).count() == 4


def test_run_stages_for_one_day(spark, policy_landing, lake):  # the chained jobs
    from daylake.plans.jobs import run_stages
    bronze, gold = f"{lake}.rb", f"{lake}.rg"
    raw_to_bronze(spark, POLICY, policy_landing, bronze, today=TODAY)
    bronze_to_gold(spark, POLICY, bronze, gold, initial="first", today=TODAY)
    reports = run_stages(spark, POLICY, policy_landing, bronze, gold, "20240203", today=TODAY)
    kinds = [(r["stage"], r["load_kind"]) for r in reports.collect()]
    assert kinds == [("bronze", "upsert"), ("gold", "upsert")]
    got = sorted((r["policy_id"], r["day"]) for r in spark.table(gold).collect())
    assert got == [(1, "03"), (2, "03")]


def test_first_load_without_typed_staging_is_the_same(spark, policy_landing, lake):
    a, b = f"{lake}.staged", f"{lake}.direct"
    ra = raw_to_bronze(spark, POLICY, policy_landing, a, "2001-01-01", "2024-02-03", today=TODAY)
    rb = raw_to_bronze(spark, POLICY, policy_landing, b, "2001-01-01", "2024-02-03", today=TODAY,
                       stage_typed=False)
    assert _report(ra) == _report(rb) == ("first", 0, 2, 2)
    assert _bronze(spark, a) == _bronze(spark, b)
    r = raw_to_bronze(spark, POLICY, policy_landing, b, "2030-01-01", "2030-01-01", today=TODAY,
                      stage_typed=False)
    assert _report(r) == ("none", 2, 0, 2)
