"""Session settings and the shared workspace folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings this library relies on; a caller's own session may differ, so
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "daylake",
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Root of the shared folder for staged tables and snapshots.

    Taken from ``spark.checkpoint.dir``, which on a cluster names storage
    every executor can reach. Only a ``local`` session, where driver and
    executors are one process, may leave it unset: then a folder under the
    local temp folder is made and registered. Elsewhere an unset folder is an
    error, since each executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="daylake-")
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the workspace for one run; never reused."""
    return f"{workspace(spark)}/daylake/{label}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written (staged data of a run that is
    done). Without a JVM gateway it stays for the storage's retention."""
    try:
        sc = spark.sparkContext
        hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    except (PySparkException, AttributeError):
        return
    hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)


@contextlib.contextmanager
def conf_override(spark: SparkSession, settings: dict[str, str]):
    """Set session settings for the block, then put the old values back."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so that plain Python can open the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


__all__ = ["DEFAULTS", "get_session", "workspace", "run_folder",
           "remove_folder", "conf_override", "local_path"]
