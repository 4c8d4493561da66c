"""Table and path checks (S5-S10) and table reads."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists on the file system Spark uses for it."""
    try:
        sc = spark.sparkContext
        jvm = sc._jvm
    except (PySparkException, AttributeError):  # Spark Connect has no gateway: ask a reader
        try:
            spark.read.option("recursiveFileLookup", "true").text(path).schema
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog check (S8, S9); a missing database is simply 'no'."""
    db, _, _ = name.rpartition(".")
    if db and not spark.catalog.databaseExists(db):
        return False
    return spark.catalog.tableExists(name)


def is_nonempty(df: DataFrame) -> bool:
    """Does the frame hold at least one row (reads one row)."""
    return not df.limit(1).isEmpty()


@dataclass(frozen=True)
class TableDetail:
    """What the catalog says about a table, from one DESCRIBE."""
    location: str
    provider: str
    kind: str                   # MANAGED or EXTERNAL
    partitions: list[str]
    properties: dict[str, str]


def table_detail(spark: SparkSession, name: str) -> TableDetail:
    quoted = ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))
    rows = [(r[0], r[1] or "") for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").collect()]
    names = [n for n, _ in rows]
    parts = []
    if "# Partition Information" in names:
        for n in names[names.index("# Partition Information") + 1:]:
            if n != "# col_name":
                if not n or n.startswith("#"):
                    break
                parts.append(n)
    # after the columns, each detail once; a column may have a detail's name
    detail = dict(rows[names.index("# Detailed Table Information"):]) if "# Detailed Table Information" in names else {}
    listed = detail.get("Table Properties", "").strip("[]")
    properties = dict(item.split("=", 1) for item in re.split(r",\s*", listed) if "=" in item)
    return TableDetail(detail.get("Location", "").rstrip("/"), detail.get("Provider", "").strip().lower(),
                       detail.get("Type", "").strip().upper(), parts, properties)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return table_detail(spark, name).partitions


def read_snapshot(spark: SparkSession, path: str,
                  schema: StructType | str | None = None) -> DataFrame:
    """Read a partitioned parquet folder by path.

    A table that has been upserted is read as the latest version of its
    manifest says, so a path read, the catalog and a registration over the
    folder agree. With a schema the partition columns keep their declared
    (string) type whatever the session's inference setting is (D10).
    """
    from daylake.plans import manifest

    if m := manifest.latest(spark, path.rstrip("/")):
        found = manifest.frame(spark, path.rstrip("/"), m)
        if schema is None:
            return found
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)
