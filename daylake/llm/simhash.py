"""SimHash near-dedup (9): multi-index hashing over 64-bit fingerprints.

Fingerprint: ASCII-lower-cased text, words between ASCII white space, word
shingles joined by one space, XXH64 (seed 42) of each; a bit is 1 if set in
over half of the hashes. A text of fewer words than a shingle is one shingle;
a text without words has fingerprint 0 and links like any other.

Search: the 64 bits are cut into three segments. Two fingerprints that differ
in at most four bits differ in at most one bit in one of the first two
segments, or in none of the third. So every distinct fingerprint is entered
under its three segment values and looks up the Hamming balls of radius 1, 1
and 0 around them (46 probes); entries and probes that meet under one value
are compared by complete distance. Links leave a bucket as a spanning forest,
never as all pairs. A bucket with more than ``tile`` entries is cut into
tiles, entries and probes both by hash, and every tile pair is compared, so
no bucket is capped and none sits in one task.

Defined results: NULL text is empty text. Rows with the same fingerprint are
one node; ``component_id`` is the smallest non-NULL ``doc_id`` of the linked
fingerprints (NULL if all are). Repeated rows come back repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from daylake.llm.common import connected_components, forest, stage

SHINGLE, MAX_BITS, SEED = 4, 4, 42
TILE = 2048
BITS = 64
CHUNK = 200_000  # hashes turned into bits at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as an unsigned integer."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in
                          zip(begins[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())),
                         np.uint64, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for s in range(0, len(hashes), CHUNK):
        part = hashes[s:s + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = SHINGLE,
                 keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) and the fingerprint
    as a signed long."""
    keep = [c for c in docs.columns if c not in (text, name)] if keep is None else keep
    fields = [f for c in keep for f in docs.schema.fields if f.name == c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(len(keep))),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(fps.view(np.int64))],
                                             names=[*keep, name])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(
        run, StructType([*fields, StructField(name, LongType())]))


def _segments(max_bits: int) -> list[tuple[int, int, int]]:
    """``(shift, width, radius)`` of each segment. With m segments and
    r = m * q + a bits, the first a + 1 have radius q, the others q - 1
    (none if that is below 0)."""
    m = 3
    q, a = divmod(max_bits, m)
    widths = [BITS // m + (k < BITS % m) for k in range(m)]
    out, shift = [], 0
    for k, w in enumerate(widths):
        radius = q if k <= a else q - 1
        if radius >= 0:
            out.append((shift, w, radius))
        shift += w
    return out


def _ball(width: int, radius: int) -> list[int]:
    from itertools import combinations

    return [sum(1 << k for k in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= max_bits


def bucket_links(keys: np.ndarray, fps: np.ndarray, own: np.ndarray, max_bits: int,
                 small: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the buckets of rows sorted by key, entries first.

    Every entry meets every row of its bucket. Buckets of up to ``small``
    comparisons are expanded together; larger ones are walked as a forest.
    """
    if not len(keys):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    entries = np.add.reduceat(own.astype(np.int64), starts)
    out_a, out_b = [], []
    todo = (entries > 0) & (sizes > 1)
    few = todo & (entries * sizes <= small)
    if few.any():
        s, n, e = starts[few], sizes[few], entries[few]
        cells = n * e
        base = np.repeat(np.cumsum(cells) - cells, cells)
        k = np.arange(cells.sum()) - base
        width = np.repeat(n, cells)
        first = np.repeat(s, cells)
        a, b = fps[first + k // width], fps[first + k % width]
        hit = (a != b) & (np.bitwise_count(a ^ b) <= max_bits)
        out_a.append(a[hit])
        out_b.append(b[hit])
    for s, n, e in zip(starts[todo & ~few], sizes[todo & ~few], entries[todo & ~few]):
        left, right = fps[s:s + e], fps[s:s + n]
        i, j = forest(left, right, lambda x, y, u=left, v=right: _close(u[x], v[y], max_bits))
        differ = left[i] != right[j]
        out_a.append(left[i][differ])
        out_b.append(right[j][differ])
    if not out_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(nodes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct fingerprints ``fp`` of
    ``nodes`` wherever two differ in at most ``max_bits`` bits."""
    segments = _segments(max_bits)
    # dealt anew, by a hash (by the fingerprint itself they are already dealt, into few
    # tasks): distinct fingerprints are small beside the probes they expand into
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    value = [F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
             for shift, width, _ in segments]
    tag = [F.lit(k << 58) for k in range(len(segments))]
    probes = [F.struct(t.bitwiseOR(v.bitwiseXOR(F.lit(flip))).alias("key"), F.lit(flip == 0).alias("own"))
              for t, v, (_, width, radius) in zip(tag, value, segments) for flip in _ball(width, radius)]
    entries = nodes.select(F.explode(F.array(*[t.bitwiseOR(v) for t, v in zip(tag, value)])).alias("key"))
    crowded = stage(entries.groupBy("key").count().where(F.col("count") > tile)
                    .select("key", F.ceil(F.col("count") / tile).cast("int").alias("cuts")), "simhash-crowded")
    rows = (nodes.select("fp", F.explode(F.array(*probes)).alias("p"))
            .select(F.col("p.key").alias("key"), "fp", F.col("p.own").alias("own"))
            .join(crowded, "key", "left"))
    cut = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    whole = F.sequence(F.lit(0), F.col("cuts") - 1)
    # In a crowded bucket an entry goes to the tiles (its cut, any) and, as a
    # probe, to (any, its cut).
    def place(as_entry):
        cell = (lambda x: cut * F.col("cuts") + x) if as_entry else (lambda x: x * F.col("cuts") + cut)
        return F.transform(whole, lambda x: F.struct(cell(x).alias("tile"), F.lit(as_entry).alias("entry")))
    placed = F.when(F.col("cuts").isNull(), F.array(F.struct(F.lit(0).alias("tile"), F.col("own").alias("entry")))) \
        .when(F.col("own"), F.concat(place(True), place(False))).otherwise(place(False))
    rows = (rows.select("key", "fp", F.explode(placed).alias("t"))
            .select("key", F.col("t.tile").alias("tile"), "fp", F.col("t.entry").alias("entry"))
            .repartition("key", "tile").sortWithinPartitions("key", "tile", F.desc("entry"), "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [np.asarray(batch.column(k)) if k != 3 else np.asarray(batch.column(k).to_numpy(zero_copy_only=False), bool)
                   for k in range(4)]
            now[2] = now[2].view(np.uint64)
            if held is not None:
                now = [np.concatenate((h, x)) for h, x in zip(held, now)]
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            if last.all():  # one bucket so far: settle its probes, keep its entries
                if now[3].all() or len(now[0]) < 4 * tile:
                    held = now
                    continue
                yield _links(now, max_bits)
                held = [x[now[3]] for x in now]
                continue
            yield _links([x[~last] for x in now], max_bits)
            held = [x[last] for x in now]
        if held is not None:
            yield _links(held, max_bits)

    return rows.mapInArrow(run, "a long, b long")


def _links(rows: list[np.ndarray], max_bits: int) -> pa.RecordBatch:
    # a bucket's tiles are separate runs: number the runs
    change = np.concatenate(([False], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])))
    a, b = bucket_links(np.cumsum(change), rows[2], rows[3], max_bits)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _named(docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int, tile: int) -> DataFrame:
    """``doc_id``, ``row`` (hash of the whole row), ``fp``, and of the group
    ``component_id`` and the ``stays`` row's id and hash."""
    hashed = [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    marked = stage(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(*hashed).alias("row"),
                                            F.col(text).alias("text")), shingle=shingle), "simhash-fp")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("id"), F.min(rank).alias("rank"))
    label = connected_components(links(nodes.select("fp"), max_bits, tile))
    # staged, so that the join deals both sides anew and a large group can be split
    grouped = stage(nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left")
                    .withColumn("component", F.coalesce("component", "fp")), "simhash-groups")
    first = stage(grouped.groupBy("component").agg(F.min("id").alias("component_id"), F.min("rank").alias("stays")),
                  "simhash-first")
    named = stage(grouped.join(first, "component").select("fp", "component_id", "stays"), "simhash-names")
    return marked.join(named, "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed long), ``component_id``."""
    return _named(docs, doc_id, text, shingle, max_bits, tile).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one with
    the smallest ``doc_id`` (NULL last), then the smallest hash of the row; of
    rows equal in every column one stays."""
    hashed = [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    near = stage(_named(docs, doc_id, text, shingle, max_bits, tile)
                 .select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"),
                         (F.col("doc_id").eqNullSafe(F.col("stays.id"))
                          & (F.col("row") == F.col("stays.row"))).alias("stays")), "simhash-stays")
    gone = near.where("not stays").select("__id", "__row").distinct()
    marked = docs.withColumn("__hash", F.xxhash64(*hashed))
    kept = marked.join(gone, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__row")), "left_anti")
    if not near.where("stays").groupBy("__id", "__row").count().where("count > 1").isEmpty():
        # rows repeated in full: row_number = 1 is pre-limited in each map task
        kept = (kept.withColumn("__n", F.row_number().over(Window.partitionBy(doc_id, "__hash").orderBy("__hash")))
                .where("__n = 1").drop("__n"))
    return kept.drop("__hash")


def fingerprint_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


__all__ = ["fingerprint", "fingerprints", "links", "near_duplicates", "drop_near_duplicates", "fingerprint_hex"]
