"""Dated landing files: scan by the date in the file name.

Landing files are CSV with a header, named ``<anything><YYYYMMDD>.csv``.
The window filter is put on ``_metadata.file_name`` so that Spark prunes
whole files before it opens them; the lineage column is the scan's own
``_metadata.file_path``, which stays correct across shuffles.

CSV only (D6): the date rule ``<8 digits>.csv`` and the reader both assume
it. Spark lists the folders itself, with no page limit on the listing (D7).
"""

from __future__ import annotations

import csv
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daylake.functions.dates import to_compact
from daylake.functions.lineage import name_date
from daylake.sources.tables import path_exists

# Spark's default quoting (a backslash escapes a quote), as in the reference;
# ``RFC4180`` reads files that write a quote inside a quoted value twice.
CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE"}
RFC4180 = {"escape": '"'}
# Filled for lines that do not have the schema's columns.
CORRUPT = "_corrupt_line"


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
             strict: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """CSV scan with header and an explicit schema.

    Columns bind by position, as with any CSV header; ``strict=True`` makes
    Spark compare the header with the schema and fail on a mismatch (D8).
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    if strict:
        reader = reader.option("enforceSchema", "false")
    if options:
        reader = reader.options(**options)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def _reader(spark: SparkSession, schema: StructType, strict: bool, options: dict[str, str] | None):
    read = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    reader = (spark.read.schema(read).options(**CSV_OPTIONS)
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("pathGlobFilter", "*.csv")
              .option("recursiveFileLookup", "true"))
    if strict:
        reader = reader.option("enforceSchema", "false")
    return reader.options(**options) if options else reader


def _roots(spark: SparkSession, roots: str | Iterable[str]) -> list[str]:
    roots = [roots] if isinstance(roots, str) else list(roots)
    missing = [r for r in roots if not path_exists(spark, r)]
    if missing:
        raise FileNotFoundError(f"no such landing folder: {', '.join(missing)}")
    return roots


def _within(ymd, start: str | None, final: str | None):
    cond = ymd != F.lit("")
    if start:
        cond = cond & (ymd >= F.lit(to_compact(start)))
    if final:
        cond = cond & (ymd <= F.lit(to_compact(final)))
    return cond


def _lineage(df: DataFrame, columns: Sequence, start: str | None, final: str | None) -> DataFrame:
    ymd = name_date(F.col("_metadata.file_name"))
    return df.where(_within(ymd, start, final)).select(
        *columns, CORRUPT, F.col("_metadata.file_path").alias("file_name"), ymd.alias("year_month_day"))


def scan_dated(spark: SparkSession, roots: str | Iterable[str], schema: StructType,
               start: str | None = None, final: str | None = None,
               strict: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """S1 + S2 + P3 + P4: rows of the ``*.csv`` files under ``roots`` whose
    name date lies in ``[start, final]`` (both included, either form; ``None``
    leaves that end open).

    Adds ``file_name`` (full path of the row's file), ``year_month_day`` and
    ``_corrupt_line``: the text of a line that has not the schema's columns
    (NULL for a good line), so that a report can count those lines. A root
    that does not exist raises; an empty folder has no rows. Columns bind by
    position; see ``scan_by_header``.
    """
    df = _reader(spark, schema, strict, options).csv(_roots(spark, roots))
    return _lineage(df, schema.fieldNames(), start, final)


def scan_files(spark: SparkSession, paths: Sequence[str], schema: StructType,
               options: dict[str, str] | None = None) -> DataFrame:
    """``scan_dated`` of the given files."""
    if not paths:
        names = [*schema.fieldNames(), CORRUPT, "file_name", "year_month_day"]
        return spark.createDataFrame([], StructType([StructField(n, StringType(), True) for n in names]))
    return _lineage(_reader(spark, schema, False, options).csv(list(paths)), schema.fieldNames(), None, None)


def list_files(spark: SparkSession, roots: str | Iterable[str], start: str | None = None,
               final: str | None = None) -> DataFrame:
    """``(path, length, modified, year_month_day)`` of the dated files in the
    window. Lists the files, opens none."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
              .option("recursiveFileLookup", "true").load(_roots(spark, roots))
              .select("path", "length", F.col("modificationTime").alias("modified"),
                      name_date(F.element_at(F.split("path", "/"), -1)).alias("year_month_day")))
    return listed.where(_within(F.col("year_month_day"), start, final))


def _first_line(spark: SparkSession, path: str) -> str:
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(sc._jsc.hadoopConfiguration()).open(hpath)
    try:
        java = sc._jvm.java.io
        return java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by their header line (names trimmed, as written). The first
    line of each file is read on the driver, 16 at a time."""
    with ThreadPool(16) as pool:
        lines = pool.map(lambda path: _first_line(spark, path), paths)
    out: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(paths, lines):
        names = next(csv.reader([line.lstrip("\ufeff")]), [])
        out.setdefault(tuple(n.strip() for n in names), []).append(path)
    return out


def scan_by_header(spark: SparkSession, roots: str | Iterable[str], schema: StructType,
                   start: str | None = None, final: str | None = None,
                   options: dict[str, str] | None = None, required: Sequence[str] = (),
                   paths: Sequence[str] | None = None) -> DataFrame:
    """``scan_dated`` with columns bound by the header's names (D8), not by
    position: one scan per distinct header, unioned by name.

    Names match without regard to case. Columns the schema has not are
    ignored, those a file has not are NULL; a file without a ``required`` column,
    or with one name twice, raises before anything is read. ``paths`` scans
    these files instead of a window."""
    if paths is None:
        paths = [r["path"] for r in list_files(spark, roots, start, final).select("path").collect()]
    scans = []
    for names, files in sorted(headers(spark, paths).items()):
        lower = [n.lower() for n in names]
        if absent := [c for c in required if c.lower() not in lower]:
            raise ValueError(f"{files[0]}: the header has no {', '.join(absent)}")
        if len(set(lower)) < len(lower):
            raise ValueError(f"{files[0]}: a name stands twice in the header {names}")
        given = [f"c{k}" for k in range(len(names))]
        read = StructType([StructField(g, StringType(), True) for g in given])
        place = dict(zip(lower, given))
        columns = [F.col(place[f.name.lower()]).alias(f.name) if f.name.lower() in place
                   else F.lit(None).cast("string").alias(f.name) for f in schema.fields]
        scans.append(_lineage(_reader(spark, read, False, options).csv(files), columns, None, None))
    return reduce(DataFrame.unionByName, scans) if scans else scan_files(spark, [], schema, options)


def file_counts(spark: SparkSession, roots: str | Iterable[str], start: str | None = None,
                final: str | None = None) -> dict[str, int]:
    """How many ``*.csv`` files lie in the window, outside it, and without a
    date in their name. Lists the files, opens none."""
    roots = [roots] if isinstance(roots, str) else list(roots)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", "true").load(roots)
             .select(name_date(F.element_at(F.split("path", "/"), -1)).alias("ymd")))
    inside = F.lit(True)
    if start:
        inside = inside & (F.col("ymd") >= F.lit(to_compact(start)))
    if final:
        inside = inside & (F.col("ymd") <= F.lit(to_compact(final)))
    dated = F.col("ymd") != ""
    row = files.agg(F.count(F.when(dated & inside, 1)).alias("files_read"),
                    F.count(F.when(dated & ~inside, 1)).alias("files_outside"),
                    F.count(F.when(~dated, 1)).alias("files_undated")).first()
    return row.asDict()
