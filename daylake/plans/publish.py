"""Table writes: first load, partition-scoped upsert, catalog DDL (K1-K8).

Partitioned tables are parquet (snappy) in their database's folder, partitioned
by ``year/month/day`` by default, and external to their catalog entry: the files
outlive it. Formats with ``MERGE INTO`` (Delta, Iceberg) use that instead of the
upsert below (that branch has not run here: no such format is installed).

The upsert rewrites only the partitions it touches, never the whole table:

1. the source's types are reconciled with the table's (``functions.types``):
   cast, or refused before anything is written; a wider source widens the
   table's column;
2. one scan of the target's key and partition columns, joined with the
   source keys, gives per partition the rows and the rows whose key is in
   the source (a small table, one row per partition). With a key index
   (``key_index``) it reads only the partitions that can hold a source key;
3. the touched partitions (those with a matched row, plus those the source
   writes to) are written whole as *unmatched old rows + source rows* to a
   new folder of the run, by one job, and read back under the table's schema;
   nothing visible changes (D1);
4. the next version of the table's manifest (``manifest``) is committed; it
   fails if another writer was faster, and the upsert then plans again;
5. the catalog follows the manifest: partitions that receive source rows
   first, then those that only lose rows, then those left without rows are
   dropped. Folders that no version needs any more go after ``retention_hours``.
   A run that dies before step 4 has changed nothing; one that dies later is
   completed by the next run.

Rows with a NULL key match nothing; they go beside the joins. With
``replay_by`` (the file name in bronze, the day in gold) those of a load that
runs again are replaced by it instead of being added once more.

Source keys are broadcast only when their count and byte size are checked
to be within ``broadcast_rows`` / ``broadcast_bytes``. Beyond that the joins
shuffle on the keys: the statistics pass moves the target's key and partition
columns only, and for the rewrite the keys that occur in the target are found
first and broadcast if they are few; only when they are many too do the rows
of the touched partitions shuffle, and they are then regrouped by partition
before the write. The source should be staged (written) first: it is read
more than once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from daylake.functions.types import reconcile
from daylake.operators.filters import partition_predicate
from daylake.operators.upsert import null_key
from daylake.plans import key_index, manifest
from daylake.plans.manifest import CommitConflict, Manifest
from daylake.plans.manifest import name as _name
from daylake.plans.manifest import quoted as _quoted
from daylake.session import conf_override, remove_folder, run_folder
from daylake.sources.tables import path_exists, table_detail

# Source keys are broadcast only below both limits, checked on the data:
# the key count and the estimated key bytes (hash-table overhead aside).
BROADCAST_ROWS = 5_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
COMPRESSION = "snappy"
_HIT = "__hit"


@dataclass
class UpsertStats:
    rows_before: int
    rows_source: int
    rows_matched: int
    rows_after: int
    partitions_rewritten: list = field(default_factory=list)
    partitions_dropped: list = field(default_factory=list)
    broadcast: bool = False
    rewrite_broadcast: bool = False
    partitions_total: int = 0               # of the table, before
    partitions_read: int | None = None      # by the statistics pass; None: all
    retries: int = 0


def create_database(spark: SparkSession, name: str, location: str | None = None,
                    comment: str | None = None,
                    properties: dict[str, str] | None = None) -> None:
    """K7. ``owner`` is reserved in Spark, so it is stored as ``data_owner``."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_name(name)}"
    if comment:
        sql += f" COMMENT {_quoted(comment)}"
    if location:
        sql += f" LOCATION {_quoted(location)}"
    if properties:
        props = {("data_owner" if k == "owner" else k): v for k, v in properties.items()}
        sql += " WITH DBPROPERTIES (" + ", ".join(
            f"{_quoted(k)}={_quoted(v)}" for k, v in props.items()) + ")"
    spark.sql(sql)


def _observed(df: DataFrame, observation: Observation | None, metrics: Sequence) -> DataFrame:
    """Attach the metrics last, right under the write: they are then counted
    in the write stage itself (an action), so retried tasks count once."""
    if observation is None:
        return df
    return df.observe(observation, *(metrics or [F.count(F.lit(1)).alias("rows")]))


def stage(df: DataFrame, path: str, rebalance_by: Sequence[str] = (),
          observation: Observation | None = None, metrics: Sequence = ()) -> DataFrame:
    """Write ``df`` to ``path`` (shared storage) and read it back.

    Cuts the lineage: later reads neither recompute the CSV parse nor
    depend on executors that may be gone. ``rebalance_by`` groups the rows
    by those columns (skew-split by AQE) so that a later partitioned write
    from the staged files stays map-only with few files per partition.
    """
    if rebalance_by:
        df = df.hint("rebalance", *rebalance_by)
    df = _observed(df, observation, metrics)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, table: str, partitions: Sequence[str],
                observation: Observation | None = None, rebalance: bool = True,
                table_format: str = "parquet", metrics: Sequence = ()) -> None:
    """K1 / K4 first load: a new partitioned table (parquet, snappy) in its
    database's folder; without partition columns, a managed one.

    With ``rebalance`` the rows are regrouped by the partition columns first
    (the REBALANCE hint): AQE sizes the write tasks by bytes and splits a
    day that holds a large share of the rows over several tasks. Without
    it, every upstream shuffle task would write one file into every day it
    holds: shuffle partitions x days small files.
    """
    if rebalance and partitions:
        df = df.hint("rebalance", *partitions)
    df = _observed(df, observation, metrics)
    writer = (df.write.format(table_format).option("compression", COMPRESSION)
              .partitionBy(*partitions).mode("overwrite"))
    if partitions and table_format == "parquet":
        writer = writer.option("path", default_location(df.sparkSession, table))
    writer.saveAsTable(table)


def default_location(spark: SparkSession, table: str) -> str:
    """``<folder of its database>/<table>``."""
    db, _, own = table.replace("`", "").rpartition(".")
    return f"{spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{own}"


def _key_bytes(df: DataFrame, keys: Sequence[str]):
    """Per-row byte estimate of the key columns: fixed widths, string lengths."""
    widths = []
    for f in df.select(*keys).schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            widths.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + F.lit(8))
        else:
            widths.append(F.lit(16))  # upper bound for numbers, dates, decimals
    return reduce(lambda a, b: a + b, widths)


def key_frame(src: DataFrame, keys: Sequence[str], use_broadcast: bool,
              source_unique: bool) -> DataFrame:
    """The source's non-NULL keys, once each, for the joins."""
    key_side = src.select(*keys).where(~null_key(keys))
    if not source_unique:
        key_side = key_side.distinct()
    return F.broadcast(key_side) if use_broadcast else key_side


def stats_frame(target: DataFrame, key_side: DataFrame, keys: Sequence[str],
                parts: Sequence[str], replayed: DataFrame | None = None) -> DataFrame:
    """Step 1 as a lazy frame: per target partition, its rows and the rows
    that the source replaces: those whose key is among the source keys, and
    NULL-key rows of a replayed load. Reads keys, partition values and the
    replay columns; ``name_<part>`` is the value as the catalog spells it."""
    keyed = (target.where(~null_key(keys)).select(*keys, *parts)
             .join(key_side.withColumn(_HIT, F.lit(1)), list(keys), "left").select(*parts, _HIT))
    nulls = target.where(null_key(keys))
    if replayed is None:
        nulls = nulls.select(*parts, F.lit(None).cast("int").alias(_HIT))
    else:
        on = replayed.columns
        nulls = (nulls.select(*dict.fromkeys([*parts, *on]))
                 .join(replayed.withColumn(_HIT, F.lit(1)), on, "left").select(*parts, _HIT))
    return (keyed.unionByName(nulls).groupBy(*parts)
            .agg(F.count(F.lit(1)).alias("rows"), F.count(_HIT).alias("hits"))
            .withColumns({f"name_{p}": F.col(p).cast("string") for p in parts}))


@dataclass
class UpsertPlan:
    """What an upsert will do: its counts and the lazy frame of the rewrite."""
    table: str
    columns: list
    partitions: list
    rewrite: DataFrame | None
    stats: UpsertStats
    source_parts: set = field(default_factory=set)
    root: str = ""
    base: Manifest | None = None        # the version planned on; None: the table has none yet
    schema: StructType | None = None    # the table's, after the upsert
    rows_written: int = 0               # rows the rewrite must have
    keys: list = field(default_factory=list)


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``; what it has not is NULL."""
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name.lower() not in kinds:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif kinds[f.name.lower()] == f.dataType:
            out.append(F.col(f.name).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def plan_upsert(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
                broadcast_rows: int = BROADCAST_ROWS,
                broadcast_bytes: int = BROADCAST_BYTES,
                source_unique: bool = False, replay_by: Sequence[str] = ()) -> UpsertPlan:
    """Steps 1-2 of the upsert without writing: the table's next schema, counts
    per partition and the rewrite of the touched partitions (``None`` if the
    source is empty). The target is read through the catalog (S6, S7), brought
    up to the latest version first. ``source_unique`` says the source holds each
    non-NULL key once (a deduplicated source), which saves the shuffle that
    makes the key side distinct."""
    detail = table_detail(spark, table)
    parts, root = detail.partitions, detail.location
    if not parts:
        raise ValueError(f"{table} is not partitioned")
    base = manifest.latest(spark, root)
    manifest.sync(spark, table, root, base, detail=detail)
    schema, stale = reconcile(spark.table(table).schema, source.schema, parts, table)
    target = _typed(spark.table(table), schema)
    columns = schema.fieldNames()
    # an empty text is no folder name: Spark writes it to the NULL partition
    src = _typed(source, schema).withColumns({p: F.nullif(F.col(p), F.lit("")) for p in parts
                                              if isinstance(schema[p].dataType, StringType)})

    # one pass over the (staged) source: rows per partition, and upper bounds
    # of the key count and key bytes for the broadcast check
    no_key = null_key(keys)
    src_per_part = (src.groupBy(*parts)
                    .agg(F.count(F.lit(1)).alias("rows"),
                         F.count(F.when(~no_key, 1)).alias("keyed"),
                         F.sum(F.when(~no_key, _key_bytes(src, keys))).alias("bytes"))
                    .withColumns({f"name_{p}": F.col(p).cast("string") for p in parts}).collect())
    src_rows = sum(r["rows"] for r in src_per_part)
    if src_rows == 0:
        before = base.rows if base else target.count()
        return UpsertPlan(table, columns, parts, None, UpsertStats(before, 0, 0, before), root=root, base=base)
    key_rows = sum(r["keyed"] for r in src_per_part)
    key_bytes = sum(r["bytes"] or 0 for r in src_per_part)
    use_broadcast = key_rows <= broadcast_rows and key_bytes <= broadcast_bytes
    key_side = key_frame(src, keys, use_broadcast, source_unique)
    replayed = src.where(no_key).select(*replay_by).distinct() if replay_by and src_rows > key_rows else None

    # 1. rows and matched rows per target partition: reads keys + partitions,
    #    of the partitions that may hold a source key; the rows of the others
    #    are known
    may = None
    if base and not stale:
        may = key_index.candidates(spark, root, base, src, keys, key_rows, replayed is not None)
    if may is None:
        per_part = stats_frame(target, key_side, keys, parts, replayed).collect()
        rows_of = {}
    else:
        read = _typed(manifest.frame(spark, root, base, may), schema)
        per_part = stats_frame(read, key_side, keys, parts, replayed).collect() if may else []
        rows_of = {n: e.rows for n, e in base.entries.items()}
    named = {tuple(r[f"name_{p}"] for p in parts): tuple(r[p] for p in parts)
             for r in [*src_per_part, *per_part]}
    label = lambda r: tuple(r[f"name_{p}"] for p in parts)
    src_parts = {label(r) for r in src_per_part}
    rows_of |= {label(r): r["rows"] for r in per_part}
    hits = {label(r): r["hits"] for r in per_part}
    before, matched = sum(rows_of.values()), sum(hits.values())
    touched_old = set(rows_of) if stale else {n for n, h in hits.items() if h > 0}
    emptied = [n for n, h in hits.items() if h > 0 and h == rows_of[n] and n not in src_parts]

    # 2. rewrite the touched partitions: all rows of a partition the write
    #    reaches must be in the output
    in_order = lambda names: sorted(names, key=lambda n: [(x is None, x or "") for x in n])
    touched = in_order(touched_old | src_parts)
    old = target if stale else target.where(partition_predicate(parts, [named[n] for n in touched]))
    keyed, nulls = old.where(~no_key), old.where(no_key)
    rewrite_broadcast = use_broadcast
    if not use_broadcast and matched <= broadcast_rows:
        # of the many source keys, those that the target has
        hit = stage(key_side.join(keyed.select(*keys), list(keys), "left_semi"),
                    run_folder(spark, "upsert-hits"))
        if (hit.agg(F.sum(_key_bytes(hit, keys))).first()[0] or 0) <= broadcast_bytes:
            key_side, rewrite_broadcast = F.broadcast(hit), True
    keyed = keyed.join(key_side, list(keys), "left_anti")
    if replayed is not None:
        nulls = nulls.join(replayed, replayed.columns, "left_anti")
    rewrite = keyed.select(*columns).unionByName(nulls.select(*columns)).unionByName(src)
    if not rewrite_broadcast:  # the rows were shuffled by key: few files per partition again
        rewrite = rewrite.hint("rebalance", *parts)
    stats = UpsertStats(before, src_rows, matched, before - matched + src_rows,
                        touched, in_order(emptied), use_broadcast, rewrite_broadcast,
                        len(rows_of), None if may is None else len(may))
    return UpsertPlan(table, columns, parts, rewrite, stats, src_parts, root, base, schema,
                      sum(rows_of.get(n, 0) - hits.get(n, 0) for n in touched) + src_rows, list(keys))


def table_location(spark: SparkSession, table: str) -> str:
    return table_detail(spark, table).location


def _moved_on(spark: SparkSession, plan: UpsertPlan) -> bool:
    now = manifest.latest(spark, plan.root)
    return (now.version if now else 0) != (plan.base.version if plan.base else 0)


def apply_upsert(spark: SparkSession, plan: UpsertPlan, retention_hours: float = 0.0) -> UpsertStats:
    """Steps 3-5: write the rewrite beside the table's files, check it, commit
    the next version, bring the catalog up to it. ``CommitConflict`` if another
    writer has committed since the plan was made; what was written then goes."""
    if plan.rewrite is None:
        return plan.stats
    stats, root = plan.stats, plan.root
    base = plan.base or manifest.from_catalog(spark, plan.table, root, plan.partitions)
    run = uuid.uuid4().hex[:12]
    folder = f"{root}/{manifest.RUN}={run}"
    try:
        plan.rewrite.write.option("compression", COMPRESSION).partitionBy(*plan.partitions).parquet(folder)
        written = manifest.written_entries(spark, root, run, plan.schema, plan.partitions)
        if (rows := sum(e.rows for e in written.values())) != plan.rows_written:
            raise RuntimeError(f"{plan.table}: wrote {rows} rows, planned {plan.rows_written}")
        if other := set(written) - set(stats.partitions_rewritten):
            raise RuntimeError(f"{plan.table}: wrote partitions that were not planned, such as {other.pop()}")
        base, gone = manifest.expired(base, retention_hours)
        new = base.following(written, stats.partitions_dropped, plan.schema)
        if indexed := key_index.keys_of(spark, root):
            key_index.build(spark, root, new, indexed, written, run)
        manifest.commit(spark, root, new)
    except Exception as error:
        remove_folder(spark, folder)
        remove_folder(spark, f"{root}/{key_index.FOLDER}/{run}")
        if not isinstance(error, CommitConflict) and _moved_on(spark, plan):
            raise CommitConflict(f"{plan.table}: changed while it was rewritten") from error
        raise
    _settle(spark, plan.table, root, base, new, gone, retention_hours, plan.source_parts)
    return stats


def upsert_partitions(spark: SparkSession, table: str, source: DataFrame,
                      keys: Sequence[str], broadcast_rows: int = BROADCAST_ROWS,
                      broadcast_bytes: int = BROADCAST_BYTES,
                      source_unique: bool = False, replay_by: Sequence[str] = (),
                      retention_hours: float = 0.0, retries: int = 5) -> UpsertStats:
    """K2 / K6 on a table: matched keys are replaced, new keys inserted. If
    another writer commits in between, the upsert plans again on its version.
    Superseded files stay for ``retention_hours`` for readers of older versions."""
    for again in range(retries + 1):
        plan = plan_upsert(spark, table, source, keys, broadcast_rows, broadcast_bytes, source_unique, replay_by)
        try:
            stats = apply_upsert(spark, plan, retention_hours)
        except CommitConflict:
            if again == retries:
                raise
            continue
        stats.retries = again
        return stats
    raise AssertionError("not reached")


def replace_table(spark: SparkSession, table: str, rows: DataFrame, retention_hours: float = 0.0,
                  observation: Observation | None = None, metrics: Sequence = ()) -> Manifest:
    """All of a partitioned table's rows replaced in one commit: written beside
    the old files, read back, then switched. Within ``retention_hours``
    ``restore_version`` brings the old rows back."""
    detail = table_detail(spark, table)
    parts, root = detail.partitions, detail.location
    base = manifest.latest(spark, root)
    manifest.sync(spark, table, root, base, detail=detail)
    base = base or manifest.from_catalog(spark, table, root, parts)
    schema, _ = reconcile(base.schema, rows.schema, parts, table)
    run = uuid.uuid4().hex[:12]
    folder = f"{root}/{manifest.RUN}={run}"
    indexed = key_index.keys_of(spark, root)
    try:
        out = _observed(_typed(rows, schema).hint("rebalance", *parts), observation, metrics)
        out.write.option("compression", COMPRESSION).partitionBy(*parts).parquet(folder)
        written = manifest.written_entries(spark, root, run, schema, parts)
        base, gone = manifest.expired(base, retention_hours)
        new = base.following(written, [n for n in base.entries if n not in written], schema)
        if indexed:
            key_index.build(spark, root, new, indexed, written, run)
        manifest.commit(spark, root, new)
    except Exception:
        remove_folder(spark, folder)
        remove_folder(spark, f"{root}/{key_index.FOLDER}/{run}")
        raise
    _settle(spark, table, root, base, new, gone, retention_hours)
    return new


def restore_version(spark: SparkSession, table: str, version: int) -> Manifest:
    """Make an older version the table's next one. Its files must still be
    there: superseded within their retention."""
    root = table_location(spark, table)
    base = manifest.latest(spark, root)
    manifest.sync(spark, table, root, base)
    old = manifest.load(spark, root, version)
    if lost := [e.folder for e in old.entries.values() if not path_exists(spark, f"{root}/{e.folder}")]:
        raise ValueError(f"{table}: version {version} has lost {len(lost)} partitions, such as {lost[0]}")
    new = base.following(old.entries, [n for n in base.entries if n not in old.entries], old.schema)
    manifest.commit(spark, root, new)
    manifest.sync(spark, table, root, new, base)
    return new


def _settle(spark: SparkSession, table: str, root: str, base: Manifest, new: Manifest, gone: Sequence[str],
            retention_hours: float, first: Sequence = ()) -> None:
    """After a commit: the catalog, then the folders whose retention is over."""
    manifest.sync(spark, table, root, new, base, first)
    for old in {*gone, *manifest.expired(new, retention_hours)[1]}:
        remove_folder(spark, f"{root}/{old}")
    indexed = key_index.keys_of(spark, root)
    if indexed and key_index.kinds(base.schema, indexed) != key_index.kinds(new.schema, indexed):
        key_index.rebuild(spark, root, new, indexed)
    elif retention_hours <= 0:
        key_index.drop_unused(spark, root, base, new)


def index_keys(spark: SparkSession, table: str, keys: Sequence[str]) -> None:
    """Index the keys of all partitions (``key_index``); later upserts keep the
    index up to date. Gives the table a manifest if it has none."""
    detail = table_detail(spark, table)
    parts, root = detail.partitions, detail.location
    m = manifest.latest(spark, root)
    if m is None:
        m = manifest.from_catalog(spark, table, root, parts)
        m = m.following({}, [], m.schema)
        manifest.commit(spark, root, m)
        manifest.sync(spark, table, root, m, m)
    key_index.build(spark, root, m, keys, m.entries, f"all-{uuid.uuid4().hex[:12]}")


def may_hold(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table's partitions that may hold a key of ``source``, by the key
    index; the whole table without one."""
    root = table_location(spark, table)
    m = manifest.latest(spark, root)
    if m is None:
        return spark.table(table)
    n_keys = source.where(~null_key(keys)).count()
    only = key_index.candidates(spark, root, m, source, keys, n_keys, False)
    return manifest.frame(spark, root, m, only)


def partition_rows(spark: SparkSession, table: str) -> dict[tuple, int]:
    """Rows per partition: from the manifest, else from the file footers; of a
    table without partitions its rows under the empty name."""
    detail = table_detail(spark, table)
    parts = detail.partitions
    if not parts:
        return {(): spark.table(table).count()}
    m = manifest.latest(spark, detail.location)
    if m:
        return {n: e.rows for n, e in m.entries.items()}
    counts = spark.table(table).groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"))
    return {tuple(r[f"name_{p}"] for p in parts): r["rows"]
            for r in counts.select(*manifest.named(parts), "rows").collect()}


def remove_orphans(spark: SparkSession, table: str, older_than_hours: float = 24.0) -> list[str]:
    """K5 retention: delete what runs that died before their commit left in the
    table's folder, once it is older than ``older_than_hours``."""
    return manifest.remove_orphans(spark, table_location(spark, table), older_than_hours)


def read_version(spark: SparkSession, table: str) -> DataFrame:
    """The table at its latest committed version, all of it or nothing of a
    commit in progress (the catalog switches partition by partition)."""
    root = table_location(spark, table)
    m = manifest.latest(spark, root)
    return manifest.frame(spark, root, m) if m else spark.table(table)


# Table formats whose Spark connector runs ``MERGE INTO`` (file-level rewrite
# with a transaction log). Plain parquet tables use ``upsert_partitions``.
MERGE_FORMATS = ("delta", "iceberg")


def table_format(spark: SparkSession, table: str) -> str:
    return table_detail(spark, table).provider


def merge_statement(table: str, source_view: str, keys: Sequence[str]) -> str:
    """K2 as SQL: matched -> update all columns, not matched -> insert all."""
    from daylake.operators.upsert import merge_condition
    return (f"MERGE INTO {table} AS target USING {source_view} AS delta "
            f"ON {merge_condition(keys)} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def upsert_table(spark: SparkSession, table: str, source: DataFrame,
                 keys: Sequence[str], source_unique: bool = False,
                 replay_by: Sequence[str] = (), **limits) -> UpsertStats:
    """Upsert by the table's format: ``MERGE INTO`` where the format has it,
    the partition-scoped rewrite on plain parquet."""
    if table_format(spark, table) not in MERGE_FORMATS:
        return upsert_partitions(spark, table, source, keys,
                                 source_unique=source_unique, replay_by=replay_by, **limits)
    before, src_rows = spark.table(table).count(), source.count()
    view = f"daylake_source_{uuid.uuid4().hex[:12]}"
    source.createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(table, view, keys))
    finally:
        spark.catalog.dropTempView(view)
    after = spark.table(table).count()
    return UpsertStats(before, src_rows, before + src_rows - after, after)


def register_external(spark: SparkSession, table: str, columns_ddl: str | None,
                      location: str, partitions: Sequence[str] = ()) -> None:
    """K8: catalog entry over files that already exist, then find their
    partitions (without the repair a partitioned table reads no rows).
    Without ``columns_ddl`` the columns are those of the files, and the
    partition columns are strings. A folder with a manifest is registered as
    its latest version says, columns and partitions."""
    if m := manifest.latest(spark, location.rstrip("/")):
        manifest.register(spark, table, location.rstrip("/"), m)
        return
    if columns_ddl is None:
        with conf_override(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
            found = spark.read.parquet(location).schema
        columns_ddl = manifest.columns_ddl(found.fields)
        if absent := [p for p in partitions if p not in found.fieldNames()]:
            raise ValueError(f"{location} is not partitioned by {', '.join(absent)}")
    sql = f"CREATE TABLE IF NOT EXISTS {_name(table)} ({columns_ddl}) USING parquet"
    if partitions:
        sql += f" PARTITIONED BY ({', '.join(partitions)})"
    sql += f" LOCATION {_quoted(location)}"
    spark.sql(sql)
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {_name(table)}")


def run_sql_file(spark: SparkSession, path: str, **params: str) -> None:
    """Run the ``;``-separated statements of a DDL file (``sql/``), with
    ``{name}`` placeholders filled from ``params``; other braces stay. Comment
    lines are skipped."""
    with open(path) as fh:
        text = "\n".join(ln for ln in fh.read().splitlines() if not ln.lstrip().startswith("--"))
    for key, value in params.items():
        text = text.replace("{" + key + "}", value)
    for statement in text.split(";"):
        if statement.strip():
            spark.sql(statement)


def truncate(spark: SparkSession, table: str, retention_hours: float = 0.0) -> None:
    """K5 as a user operation: remove all rows. A partitioned table commits a
    version without partitions; its files go after ``retention_hours``."""
    detail = table_detail(spark, table)
    parts, root = detail.partitions, detail.location
    if not parts or detail.provider != "parquet":
        spark.sql(f"TRUNCATE TABLE {_name(table)}")
        return
    base = manifest.latest(spark, root)
    manifest.sync(spark, table, root, base, detail=detail)
    base = base or manifest.from_catalog(spark, table, root, parts)
    new = base.following({}, list(base.entries), base.schema)
    manifest.commit(spark, root, new)
    _settle(spark, table, root, base, new, [], retention_hours)
