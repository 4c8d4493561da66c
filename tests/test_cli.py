from daylake.__main__ import main


def test_jobs_from_the_command_line(spark, policy_landing, tmp_path):
    db = f"cli_{tmp_path.name[-6:].replace('-', '_')}"
    common = ["--database", f"{db}={tmp_path}/{db}", "--today", "2024-02-03"]
    r = main(common + ["bronze", "--landing", policy_landing, "--table", f"{db}.policy",
                       "--reprocess-all", "True"], spark)
    assert r.first()["qtty_after"] == 2
    r = main(common + ["bronze", "--landing", policy_landing, "--table", f"{db}.policy"], spark)
    assert r.first()["load_kind"] == "upsert"  # cron = 2024-02-02
    r = main(common + ["gold", "--source-table", f"{db}.policy",
                       "--target-table", f"{db}.policy_prod"], spark)
    assert r.first()["load_kind"] == "first"
    r = main(common + ["gold", "--source-table", f"{db}.policy",
                       "--target-table", f"{db}.policy_prod", "--day", "cron"], spark)
    assert r.first()["load_kind"] == "upsert"


def test_stream_from_the_command_line(spark, policy_landing, tmp_path):
    db = f"clis_{tmp_path.name[-6:].replace('-', '_')}"
    common = ["--database", f"{db}={tmp_path}/{db}", "--today", "2024-02-04"]
    main(common + ["bronze", "--landing", policy_landing, "--table", f"{db}.policy",
                   "--reprocess-all", "True"], spark)
    out = main(common + ["stream", "--landing", policy_landing, "--table", f"{db}.policy",
                         "--checkpoint", str(tmp_path / "ckpt")], spark)
    assert out.count() == 4


def test_versions_from_the_command_line(spark, policy_landing, tmp_path):
    from daylake.plans.report import read_log
    db, log = f"cliv_{tmp_path.name[-6:].replace('-', '_')}", str(tmp_path / "log")
    common = ["--database", f"{db}={tmp_path}/{db}", "--today", "2024-02-10", "--log", log, "--quarantine", "--key-index",
              "--by-header", "--retention-hours", "1"]
    bronze = ["bronze", "--landing", policy_landing, "--table", f"{db}.policy", "--ledger"]
    main(common + bronze, spark)
    r = main(common + bronze, spark).first()
    assert (r["load_kind"], r["qtty_source"], r["rows_quarantined"], r["qtty_after"]) == ("upsert", 7, 2, 3)
    assert main(common + bronze, spark).first()["qtty_source"] == 0
    rows = lambda: sorted((x.policy_id, x.insured_value) for x in spark.table(f"{db}.policy").collect())
    loaded = rows()
    main(common + ["restore", "--table", f"{db}.policy", "--version", "1"], spark)
    assert rows() == [(1, 100.5), (2, 200.0)]
    assert main(common + ["rebuild", "--landing", policy_landing, "--table", f"{db}.policy"], spark).first()["load_kind"] == "rebuild"
    assert rows() == loaded
    assert main(common + ["clean", "--table", f"{db}.policy"], spark) == []
    assert read_log(spark, log).count() == 4
