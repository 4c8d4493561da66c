"""
key over all files; the survivor does not depend on partitioning."""

import datetime as dt
import os
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daylake.operators.dedup import latest_per_key
from daylake.plans.datasets import POLICY
from daylake.plans.jobs import raw_to_bronze
from tests.conftest import HEADER

TODAY = dt.date(2024, 3, 1)

rows_strategy = st.lists(
    st.tuples(st.integers(1, 6),                      # day 2024-02-0d
              st.one_of(st.none(), st.integers(1, 8)),  # policy id (NULL keys too)
              st.integers(0, 999)),                   # insured value
    min_size=1, max_size=25)


def _line(pid, value):
    return f"U,{'' if pid is None else pid},2025-01-01,Urban,NY,East,{value},Retail,N,N"


def _expected(rows):
    """Latest per key: highest day, then highest insured value; NULL keys:
    one survivor per load."""
    best, nulls = {}, 0
    for day in sorted({d for d, _, _ in rows}):
        day_rows = [(p, v) for d, p, v in rows if d == day]
        if any(p is None for p, _ in day_rows):
            nulls += 1
        for pid, value in day_rows:
            if pid is not None and (pid not in best or best[pid][0] < day or
                                    (best[pid][0] == day and best[pid][1] < value)):
                best[pid] = (day, value)
    return {p: (float(v), f"202402{d:02d}") for p, (d, v) in best.items()}, nulls


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy)
def test_day_by_day_loads_equal_latest_over_all(spark, tmp_path_factory, rows):
    root = str(tmp_path_factory.mktemp("prop"))
    days = sorted({d for d, _, _ in rows})
    for day in days:
        folder = "full-load" if day == days[0] else "cdc-load"
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        with open(f"{root}/{folder}/policy_202402{day:02d}.csv", "w") as fh:
            fh.write("\n".join([HEADER] + [_line(p, v) for d, p, v in rows if d == day]) + "\n")
    from daylake.plans.publish import create_database
    db = f"p_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, f"{root}/{db}")
    table = f"{db}.policy"
    for day in days:
        iso = f"2024-02-{day:02d}"
        raw_to_bronze(spark, POLICY, root, table, iso, iso, today=TODAY)
    got = {r["policy_id"]: (r["insured_value"], r["year_month_day"])
           for r in spark.table(table).where("policy_id is not null").collect()}
    want, nulls = _expected(rows)
    assert got == want
    assert spark.table(table).where("policy_id is null").count() == nulls


def test_survivor_independent_of_partitioning(spark):
    data = [(k % 7, k % 3, f"v{k % 5}", float(k % 11)) for k in range(400)]
    df = spark.createDataFrame(data, "k long, d long, s string, x double")
    results = []
    for n in (1, 3, 8):
        out = latest_per_key(df.repartition(n), ["k"], ["d desc"])
        results.append(sorted(tuple(r) for r in out.collect()))
    assert results[0] == results[1] == results[2]
