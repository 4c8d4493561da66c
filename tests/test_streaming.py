import datetime as dt
import os

from daylake.plans.datasets import POLICY
from daylake.plans.jobs import raw_to_bronze
from daylake.streaming import stream_to_bronze
from tests.conftest import HEADER

TODAY = dt.date(2024, 2, 4)


def _bronze(spark, table):
    return sorted(((r["policy_id"] if r["policy_id"] is not None else -1), r["insured_value"],
                   r["year_month_day"]) for r in spark.table(table).collect())


def test_stream_matches_batch_and_picks_up_new_files(spark, policy_landing, lake, tmp_path):
    batch, streamed = f"{lake}.batch", f"{lake}.streamed"
    for table in (batch, streamed):
        raw_to_bronze(spark, POLICY, policy_landing, table, today=TODAY)
    raw_to_bronze(spark, POLICY, policy_landing, batch, today=TODAY)
    ckpt = str(tmp_path / "ckpt")
    q = stream_to_bronze(spark, POLICY, policy_landing, streamed, ckpt)
    q.awaitTermination(300)
    assert _bronze(spark, streamed) == _bronze(spark, batch)

    # a late file: only it is read on the next run, and it is upserted
    with open(os.path.join(policy_landing, "cdc-load", "policy_20240205.csv"), "w") as fh:
        fh.write(HEADER + "\nU,3,2027-01-01,Urban,CA,West,999,Retail,N,N\n")
    q = stream_to_bronze(spark, POLICY, policy_landing, streamed, ckpt)
    q.awaitTermination(300)
    got = dict((k, (v, d)) for k, v, d in _bronze(spark, streamed))
    assert got[3] == (999.0, "20240205") and len(got) == 4
    # nothing new: a third run changes nothing
    before = _bronze(spark, streamed)
    stream_to_bronze(spark, POLICY, policy_landing, streamed, ckpt).awaitTermination(300)
    assert _bronze(spark, streamed) == before
