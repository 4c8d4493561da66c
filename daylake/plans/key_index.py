"""Key index of a table: which partitions may hold a key.

Per partition folder, in ``<table>/_keys``: rows, rows with a NULL key, least
and greatest value of each key column, and Bloom filters of the keys' 64-bit
hashes (32 bits a key, 16 probes: about three false hits in ten million). The
keys of a partition are dealt by a second hash to as many filters as it takes
for some ``MAX_KEYS`` rows each, one index row a filter, so that neither a task
nor an index row grows with a partition. An upsert asks the index which
partitions can hold its keys, and its statistics pass reads those only; the
others' row counts are the manifest's.

The answer errs on one side: a partition that lacks index rows is read, or
judged by its key range alone, as is any partition when the source has more than
``PROBE_KEYS`` keys. What is read is then joined exactly, so the result does not
depend on the index.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daylake.operators.upsert import null_key
from daylake.plans.manifest import RUN, Manifest, Names, scans
from daylake.session import local_path, remove_folder, run_folder
from daylake.sources.tables import path_exists

FOLDER = "_keys"
BITS_PER_KEY, PROBES = 32, 16
MAX_KEYS = 100_000          # rows of a filter (0.4 MB); a larger partition has several; 0: ranges alone
TASK_KEYS = 1_000_000       # rows whose filters one task makes, on average: 32 MB
PROBE_KEYS = 200_000        # source keys that are looked up in the filters: 1.6 MB sent along with the tasks


def key_hash(keys: Sequence[str]):
    return F.xxhash64(*keys)


def _deal(hashed: str):
    """A hash of the hash: which of a partition's filters holds the key."""
    return F.xxhash64(hashed)


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The probed bits of each hash: two halves, combined."""
    x = hashes.view(np.uint64)
    low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield (low + np.uint64(k) * high) % np.uint64(bits)


def _pack(held: np.ndarray) -> bytes:
    return np.packbits(held, bitorder="little").tobytes()


def bloom(hashes: np.ndarray) -> bytes:
    held = np.zeros(max(64, 8 * (-(-len(hashes) * BITS_PER_KEY // 8))), bool)
    for at in _places(hashes, len(held)):
        held[at] = True
    return _pack(held)


def blooms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filters of a task's hashes, batch by batch: ``slot`` says which
    filter, ``bits`` its size; a row without a hash only asks for the filter."""
    held, end, found = np.zeros(0, bool), 0, {}     # found: slot -> first and last bit
    for batch in batches:
        slot, bits = (batch.column(c).to_numpy() for c in ("slot", "bits"))
        hashes = batch.column("h")
        slots, first, of = np.unique(slot, return_index=True, return_inverse=True)
        for s, n in zip(slots.tolist(), bits[first].tolist()):
            if s not in found:
                found[s] = (end, end + n)
                end += n
        if end > len(held):
            held = np.concatenate((held, np.zeros(max(end - len(held), len(held)), bool)))
        start = np.array([found[s][0] for s in slots.tolist()], np.int64)[of]
        keyed = hashes.is_valid().to_numpy(zero_copy_only=False)
        for at in _places(hashes.fill_null(0).to_numpy()[keyed], bits[keyed]):
            held[start[keyed] + at.astype(np.int64)] = True
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int64()), pa.array([_pack(held[a:b]) for a, b in found.values()], pa.binary())],
        names=["slot", "filter"])


def may_hold(held: bytes, hashes: np.ndarray) -> bool:
    """May any of the keys be among those the filter was made of?"""
    bits = np.frombuffer(held, np.uint8)
    left = np.arange(len(hashes))       # keys whose probes all hit so far
    for at in _places(hashes, 8 * len(bits)):
        at = at[left]
        left = left[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        if not len(left):
            return False
    return True


def kinds(schema: StructType, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {schema[k].dataType.simpleString()}" for k in keys)


def _index_schema(schema: StructType, keys: Sequence[str]) -> str:
    ends = ", ".join(f"`{k}`: {schema[k].dataType.simpleString()}" for k in keys)
    return (f"folder string, rows long, nulls long, low struct<{ends}>, high struct<{ends}>, kinds string, "
            "part long, parts long, filter binary")


def build(spark: SparkSession, root: str, m: Manifest, keys: Sequence[str], names: Iterable[Names],
          label: str) -> None:
    """Index the given partitions of version ``m`` (one scan of their keys for
    the ranges, one for the filters) as ``_keys/<label>``."""
    names = list(names)
    scanned = [scan.select(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("folder"), *keys)
               for scan in scans(spark, root, m, names)]
    if not scanned:
        return
    keyed = reduce(DataFrame.unionByName, scanned)
    rows = keyed.groupBy("folder").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(null_key(keys), 1)).alias("nulls"),
        F.struct(*[F.min(k).alias(k) for k in keys]).alias("low"),
        F.struct(*[F.max(k).alias(k) for k in keys]).alias("high"), F.lit(kinds(m.schema, keys)).alias("kinds"))
    index = f"{root}/{FOLDER}/{label}"
    if not MAX_KEYS:
        rows.write.mode("overwrite").parquet(index)
        return
    # one row a folder: how many filters it has, how large, and their numbers among all
    hashes = F.col("rows") - F.col("nulls")
    rows = rows.withColumn("parts", F.greatest(F.ceil(hashes / MAX_KEYS), F.lit(1)))
    rows = rows.withColumns({
        "bits": F.greatest(8 * F.ceil(hashes * BITS_PER_KEY / (8 * F.col("parts"))), F.lit(64)),
        "slot": F.sum("parts").over(Window.orderBy("folder")) - F.col("parts")})
    ranges = run_folder(spark, "key-ranges")
    try:
        rows.write.parquet(ranges)
        rows = spark.read.schema(rows.schema).parquet(ranges)
        dealt = (keyed.where(~null_key(keys)).select("folder", key_hash(keys).alias("h"))
                 .join(F.broadcast(rows.select("folder", "parts", "bits", "slot")), "folder")
                 .select((F.col("slot") + F.pmod(_deal("h"), "parts")).alias("slot"), "bits", "h"))
        each = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        each = each.withColumn("slot", F.col("slot") + F.col("part"))
        asked = each.select("slot", "bits", F.lit(None).cast("long").alias("h"))    # a filter without keys too
        tasks = -(-sum(m.entries[n].rows for n in names) // TASK_KEYS)
        (dealt.unionByName(asked).repartition(max(1, tasks), "slot").mapInArrow(blooms, "slot long, filter binary")
         .join(F.broadcast(each.drop("bits")), "slot").drop("slot").write.mode("overwrite").parquet(index))
    finally:
        remove_folder(spark, ranges)


def keys_of(spark: SparkSession, root: str) -> list[str]:
    """The key columns the table's index was made for; none without an index."""
    if not path_exists(spark, f"{root}/{FOLDER}"):
        return []
    kinds = (spark.read.schema("kinds string").option("recursiveFileLookup", "true")
             .parquet(f"{root}/{FOLDER}").limit(1).collect())
    return [k.rpartition(" ")[0] for k in kinds[0]["kinds"].split(", ")] if kinds else []


def rebuild(spark: SparkSession, root: str, m: Manifest, keys: Sequence[str]) -> None:
    """The index made anew for all partitions, after a key's type has changed."""
    remove_folder(spark, f"{root}/{FOLDER}")
    build(spark, root, m, keys, m.entries, f"all-{m.version}")


def drop_unused(spark: SparkSession, root: str, before: Manifest, after: Manifest) -> None:
    """Remove index files of runs that hold no partition any more."""
    run = lambda m: {e.folder.split("/")[0].partition("=")[2] for e in m.entries.values()
                     if e.folder.startswith(f"{RUN}=")}
    for label in run(before) - run(after):
        remove_folder(spark, f"{root}/{FOLDER}/{label}")


def candidates(spark: SparkSession, root: str, m: Manifest, source: DataFrame, keys: Sequence[str], n_keys: int,
               null_rows: bool) -> set[Names] | None:
    """The partitions of version ``m`` that may hold a key of ``source``; with
    ``null_rows`` those with NULL-key rows too. None without an index."""
    if keys_of(spark, root) != list(keys) or kinds(m.schema, keys) != kinds(source.schema, keys):
        return None     # no index of these keys; or the keys get a wider type, which hashes differently
    index = (spark.read.schema(_index_schema(m.schema, keys)).option("recursiveFileLookup", "true")
             .parquet(f"{root}/{FOLDER}").where(F.col("kinds") == kinds(m.schema, keys)))
    keyed = source.where(~null_key(keys))
    ends = keyed.agg(*[F.min(k).alias(f"low_{k}") for k in keys], *[F.max(k).alias(f"high_{k}") for k in keys]).first()
    inside = reduce(and_, [(F.col(f"low.{k}") <= F.lit(ends[f"high_{k}"])) & (F.col(f"high.{k}") >= F.lit(ends[f"low_{k}"]))
                           for k in keys]) if n_keys else F.lit(False)
    inside = F.coalesce(inside, F.lit(False))
    base = local_path(root)
    place = lambda folder: local_path(unquote(folder))[len(base) + 1:]
    # an index made before partitions had several filters has one row a folder
    part, parts = (F.coalesce(c, F.lit(n).cast("long")).alias(c) for c, n in (("part", 0), ("parts", 1)))
    rows = index.select("folder", "nulls", inside.alias("inside"), part, parts).collect()
    indexed = {place(r["folder"]): r for r in rows}
    hit = {f for f, r in indexed.items() if r["inside"]}
    if 0 < n_keys <= PROBE_KEYS and hit:
        asked = keyed.select(key_hash(keys).alias("h")).distinct().select("h", _deal("h")).collect()
        hashes, dealt = (np.array(c, np.int64) for c in zip(*asked))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [f.as_py() for f, nth, of, held in zip(*batch.columns)
                         if not held.is_valid or may_hold(held.as_py(), hashes[dealt % of.as_py() == nth.as_py()])]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["folder"])

        there = {(place(r["folder"]), r["part"], r["parts"]) for r in rows}
        whole = {f for f in hit if all((f, k, indexed[f]["parts"]) in there for k in range(indexed[f]["parts"]))}
        hit = (hit - whole) | {place(r["folder"]) for r in index.where(inside).select("folder", part, parts, "filter")
                               .mapInArrow(probe, "folder string").distinct().collect()}
    return {n for n, e in m.entries.items() if e.folder not in indexed or e.folder in hit
            or (null_rows and indexed[e.folder]["nulls"])}


__all__ = ["build", "candidates", "drop_unused", "keys_of", "kinds", "rebuild", "bloom", "may_hold"]
