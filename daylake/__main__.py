"""Run the jobs from the command line (spark-submit or python -m daylake).

    python -m daylake bronze --landing s3a://lake/landing/policy \
        --table lake_raw.policy --start-date cron --final-date cron
    python -m daylake gold --source-table lake_raw.policy \
        --target-table lake_gold.policy --day 20240203
    python -m daylake stream --landing ... --table lake_raw.policy \
        --checkpoint s3a://lake/checkpoints/policy
    python -m daylake rebuild --landing ... --table lake_raw.policy
    python -m daylake restore --table lake_raw.policy --version 12
    python -m daylake clean --table lake_raw.policy --older-than-hours 24

Databases named with ``--database NAME=LOCATION`` are created first. The
run report is printed; a failure exits non-zero.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import replace

from daylake.plans.datasets import POLICY
from daylake.plans.jobs import bronze_to_gold, raw_to_bronze, rebuild_bronze
from daylake.plans.publish import create_database, remove_orphans, restore_version


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="daylake")
    p.add_argument("--database", action="append", default=[],
                   help="NAME=LOCATION, created if missing (repeatable)")
    p.add_argument("--today", help="run as if today were this date (YYYY-MM-DD)")
    p.add_argument("--log", help="folder of the run log, to which the report is appended")
    p.add_argument("--by-header", action="store_true", help="bind CSV columns by the header's names")
    p.add_argument("--quarantine", action="store_true", help="bad rows go to <table>_rejected")
    p.add_argument("--key-index", action="store_true", help="index the bronze table's keys on its first load")
    p.add_argument("--retention-hours", type=float, default=0.0, help="how long superseded files stay")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("bronze", help="landing files -> bronze table")
    b.add_argument("--landing", required=True, help="folder holding full-load/ and cdc-load/")
    b.add_argument("--table", required=True)
    b.add_argument("--start-date", default="cron")
    b.add_argument("--final-date", default="cron")
    b.add_argument("--reprocess-all", default="False", choices=["True", "False"])
    b.add_argument("--no-stage-typed", action="store_true",
                   help="write the data once (large first loads); counts observed on the scan")
    b.add_argument("--ledger", action="store_true",
                   help="load the files not loaded yet, whatever their date (without dates given)")
    r = sub.add_parser("rebuild", help="bronze anew from all files, switched at once")
    r.add_argument("--landing", required=True)
    r.add_argument("--table", required=True)
    v = sub.add_parser("restore", help="an older version of a table as its next one")
    v.add_argument("--table", required=True)
    v.add_argument("--version", type=int, required=True)
    c = sub.add_parser("clean", help="remove what runs that died left in a table's folder")
    c.add_argument("--table", required=True)
    c.add_argument("--older-than-hours", type=float, default=24.0)
    s = sub.add_parser("stream", help="cdc-load/ files -> bronze as a file stream")
    s.add_argument("--landing", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--checkpoint", required=True, help="stream checkpoint folder (shared storage)")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--processing-time", help="run continuously, e.g. '10 minutes'")
    g = sub.add_parser("gold", help="bronze table -> gold table")
    g.add_argument("--source-table", required=True)
    g.add_argument("--target-table", required=True)
    g.add_argument("--day", action="append", help="YYYYMMDD or cron (repeatable)")
    g.add_argument("--initial", default="all", choices=["all", "first"])
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None):
    args = parse(sys.argv[1:] if argv is None else argv)
    if spark is None:
        from daylake.session import get_session
        spark = get_session()
    today = dt.date.fromisoformat(args.today) if args.today else None
    for spec in args.database:
        name, _, location = spec.partition("=")
        create_database(spark, name, location or None)
    ds = replace(POLICY, bind_by_header=args.by_header, quarantine=args.quarantine, key_index=args.key_index,
                 retention_hours=args.retention_hours)
    if args.job == "restore":
        return restore_version(spark, args.table, args.version)
    if args.job == "clean":
        return remove_orphans(spark, args.table, args.older_than_hours)
    if args.job == "stream":
        from daylake.streaming import stream_to_bronze
        query = stream_to_bronze(spark, ds, args.landing, args.table, args.checkpoint,
                                 max_files_per_trigger=args.max_files_per_trigger,
                                 processing_time=args.processing_time, log=args.log)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        return spark.table(args.table)
    if args.job == "bronze":
        # the ledger needs no window: "cron" stands for no date given
        dates = [None if args.ledger and d == "cron" else d for d in (args.start_date, args.final_date)]
        report = raw_to_bronze(spark, ds, args.landing, args.table, *dates, args.reprocess_all == "True", today,
                               stage_typed=not args.no_stage_typed, ledger=args.ledger, log=args.log)
    elif args.job == "rebuild":
        report = rebuild_bronze(spark, ds, args.landing, args.table, today=today, log=args.log)
    else:
        day = args.day if args.day and len(args.day) > 1 else (args.day or [None])[0]
        report = bronze_to_gold(spark, ds, args.source_table, args.target_table,
                                day, args.initial, today, log=args.log)
    report.show(truncate=False, vertical=True)
    return report


if __name__ == "__main__":
    main()
