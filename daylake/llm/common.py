"""Helpers shared by the operators: staged tables, connected components,
text batches as byte buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.session import run_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: cuts the
    lineage, and a lost executor costs a re-read instead of a re-run."""
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(column: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(by)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is the
    smallest node reachable.

    Each round hooks every node to the smallest of itself and its neighbours,
    follows that pointer one step more, and rewrites the edges onto the
    pointers. Every node that is not the smallest around it merges, so the
    edges left shrink at least by half a round and only the first rounds are
    large. All of a round is joins and min-aggregates, which combine before
    the shuffle; each round is staged.
    """
    live = stage(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                 .where("a <> b").distinct(), "cc-edges")
    labels = None
    while not live.isEmpty():
        both = live.unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # staged, so that a pointer many nodes share can be split in the join
        hook = stage(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("node"), F.least("a", "m").alias("p")), "cc-hook")
        step = hook.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        parent = stage(hook.join(step, "p").select("node", F.col("pp").alias("p")), "cc-parent")
        left = parent.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        live = stage(live.join(left, "a").join(right, "b")
                     .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                     .where("a <> b").distinct(), "cc-edges")
        if labels is None:
            labels = parent.select("node", F.col("p").alias("component"))
        else:
            up = parent.select(F.col("node").alias("component"), F.col("p").alias("up"))
            labels = labels.join(up, "component", "left").select(
                "node", F.coalesce("up", "component").alias("component"))
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stage(labels, "cc-labels")


def forest(left: np.ndarray, right: np.ndarray, linked, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs ``(i, j)`` that connect what ``linked`` links between the
    ``left`` and ``right`` items: a spanning forest, not all the pairs.

    ``linked(rows, cols)`` returns the boolean matrix for two index arrays.
    Nodes are 0..len(left)-1, then len(left)+j for ``right``; a breadth-first
    walk takes one matrix row block at a time and visits each node once, so
    at most ``len(left) + len(right) - 1`` pairs come out.
    """
    n, m = len(left), len(right)
    new_l, new_r = np.ones(n, bool), np.ones(m, bool)
    out_i, out_j = [], []
    for seed in range(n):
        if not new_l[seed]:
            continue
        new_l[seed] = False
        front, from_left = np.array([seed]), True
        while len(front):
            other_new = new_r if from_left else new_l
            found: list[np.ndarray] = []
            for s in range(0, len(front), block):
                cand = np.flatnonzero(other_new)
                if not len(cand):
                    break
                part = front[s:s + block]
                hit = linked(part, cand) if from_left else linked(cand, part).T
                got = np.flatnonzero(hit.any(axis=0))
                if len(got):
                    via, to = part[hit[:, got].argmax(axis=0)], cand[got]
                    other_new[to] = False
                    found.append(to)
                    out_i.append(via if from_left else to)
                    out_j.append(to if from_left else via)
            front = np.concatenate(found) if found else np.empty(0, int)
            from_left = not from_left
    if not out_i:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate(out_i), np.concatenate(out_j)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte buffer and ``len + 1`` offsets; NULL: empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int, overlap: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut texts laid end to end into runs of about ``size`` bytes.

    Yields ``(from, to, owner, starts)``: the byte range, the text each piece
    in it belongs to and where each piece starts in the range. A text longer
    than ``size`` is cut into pieces that overlap by ``overlap`` bytes, so
    that n-grams over a cut are seen once and memory stays bounded.
    """
    owner: list[int] = []
    starts: list[int] = []
    begin = int(offsets[0])
    for k in range(len(offsets) - 1):
        lo, hi = int(offsets[k]), int(offsets[k + 1])
        if lo == hi:
            continue
        if owner and hi - begin > size:
            yield begin, lo, np.array(owner), np.array(starts)
            owner, starts, begin = [], [], lo
        if not owner:
            begin = lo
        while hi - lo > size:
            yield lo, lo + size, np.array([k]), np.array([0])
            lo += size - overlap
            begin = lo
        owner.append(k)
        starts.append(lo - begin)
    if owner:
        yield begin, int(offsets[-1]), np.array(owner), np.array(starts)


__all__ = ["table", "stage", "crc_mod", "connected_components", "forest", "utf8", "slices"]
