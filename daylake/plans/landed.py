"""Landing files made from a table: input for the driver queries and tests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.sources.landing import RFC4180

_DAY, _FOLDER = "landing_day", "landing_folder"


def write_dated_csv(df: DataFrame, root: str, date_col: str,
                    folder_col: str | None = None, prefix: str = "part") -> DataFrame:
    """Land ``df`` as CSV files named ``<prefix>-<number>-<YYYYMMDD>.csv`` under
    ``root/<folder>/``.

    Spark's partitioned CSV writer does the work (a day that holds most of the
    rows is split over tasks); its committed files are then renamed, which
    replaces files of the same names. All columns except ``date_col`` and
    ``folder_col`` are written, as strings. Returns ``(path, rows)``, one row per
    file.
    """
    spark, base = df.sparkSession, root.rstrip("/")
    day = F.col(date_col).cast("string")
    no_day = F.raise_error(F.lit(f"a row without {date_col} has no dated file"))
    folder = F.coalesce(F.col(folder_col).cast("string") if folder_col else F.lit("."), F.lit("."))
    data = [c for c in df.columns if c not in (date_col, folder_col)]
    out = df.select(*[F.col(c).cast("string").alias(c) for c in data],
                    F.when(day.isNull(), no_day).otherwise(day).alias(_DAY), folder.alias(_FOLDER))
    draft = f"{base}/_draft-{uuid.uuid4().hex[:12]}"
    (out.hint("rebalance", _FOLDER, _DAY).write.options(**RFC4180).option("header", "true")
     .partitionBy(_FOLDER, _DAY).csv(draft))

    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    fs = path(draft).getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        fs = fs.getRawFileSystem()      # leaves the checksum files behind with the draft
    landed = []
    for status in fs.globStatus(path(f"{draft}/{_FOLDER}=*/{_DAY}=*")) or []:
        here = status.getPath()
        target = here.getParent().getName().partition("=")[2]
        ymd = here.getName().partition("=")[2]
        place = base if target == "." else f"{base}/{target}"
        fs.mkdirs(path(place))
        parts = sorted(s.getPath().toString() for s in fs.listStatus(here) if s.getPath().getName().endswith(".csv"))
        for k, part in enumerate(parts):
            final = path(f"{place}/{prefix}-{k:05d}-{ymd}.csv")
            fs.delete(final, False)
            fs.rename(path(part), final)
            landed.append(final.toString())
    fs.delete(path(draft), True)
    if not landed:
        return spark.createDataFrame([], "path string, rows long")
    return (spark.read.options(**RFC4180).option("header", "true").schema(", ".join(f"`{c}` string" for c in data))
            .csv(landed).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows")))


__all__ = ["write_dated_csv"]
