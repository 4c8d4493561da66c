"""Daylake: batch lake tables fed by dated files, built on Spark DataFrames.

Stages:
  raw landing files (CSV, date in the name)
    -> bronze: typed, with lineage, one row per key, upserted by partition
    -> gold: a projected table, one day replaced by key per run

Every step is a DataFrame -> DataFrame function; only the job
functions in ``daylake.plans.jobs`` run actions (writes, counts).
"""

__version__ = "0.1.0"
