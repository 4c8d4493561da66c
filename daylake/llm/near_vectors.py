"""Embedding near-dedup (1): PCA-ordered tiled comparison.

Vectors of equal label are linked when their cosine is at least ``THRESHOLD``.
Unit vectors are turned onto the principal axes of the whole table (second
moments summed over all rows; a rotation, so cosines stay). Two linked unit
vectors are at most sqrt(2 - 2 t) apart, so also on each axis: cells of that
width on the first axes need only their neighbour cells. Cells are cut into
parts of about ``HELD_BYTES`` by hash, and every pair of parts of neighbouring
cells is one task's work, so a hot label or a dense cell spreads over many
tasks and a vector is sent once per ``HELD_BYTES`` of its neighbourhood. Inside,
tiles of ``BLOCK`` vectors are compared with each other. A tile adds the
products up axis block by axis block; the product of the remaining axes is at
most the product of the suffix norms, rows and columns without a pair that can
still reach the threshold drop out, and the tile ends when none is left. Pairs
that survive all axes are decided by the cosine of the original vectors in
double precision. Vectors are scaled by a power of two first, which changes no
cosine and keeps the squares of very small and very large numbers in range.

Vectors that are equal are one node with a count. A tile returns the number
of links of each of its nodes and a spanning forest of its links, never all
pairs; the components come from the forests.

The driver gets one matrix of second moments per vector length (length squared
numbers; one length in a table made by one model).

Defined results: a vector that is NULL, empty, zero, or holds NULL or
non-finite numbers, and one whose label or id is NULL, links with nothing
(``n_links`` 0, its own component). Vectors of different length do not link.
Rows repeated in id, label and vector count once as a partner and come back
repeated. Rows that share an id but not the vector or the label are vectors of
their own: each has its links, may be a partner of the other, and its component
is the smallest id that it reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import connected_components, forest, stage

THRESHOLD = 0.93
BLOCK = 2048
AXIS_BLOCK = 8
SLACK = 1e-9  # for sums in double precision; survivors are decided exactly
CELL_AXES = 2
HELD_BYTES = 16 << 20  # of vectors on either side of a task's work


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest number to 0.5-1."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0))
    return np.ldexp(x, -exponent[:, None])


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length as unit rows in double precision, and norms (of
    the scaled vectors)."""
    x = _scaled(np.array(column.to_pylist(), np.float64))
    norm = np.sqrt((x * x).sum(axis=1))
    return x / norm[:, None], norm


def usable(vector: str = "vector"):
    """True for vectors that may link; never NULL."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def principal_axes(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, an orthonormal basis by falling second moment. Sums
    over all rows: one partial matrix per task, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.asarray(batch.column(1))
            for dim in np.unique(sizes).tolist():
                x, _ = _units(batch.column(0).take(pa.array(np.flatnonzero(sizes == dim))))
                total[dim] = total.get(dim, 0) + x.T @ x
        for dim, m in total.items():
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dim, np.int32)), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(m[i, j])],
                names=["dim", "i", "j", "m"])

    sums = (nodes.select("vector", "dim").mapInArrow(run, "dim int, i int, j int, m double")
            .groupBy("dim", "i", "j").agg(F.sum("m").alias("m")).toPandas())
    axes = {}
    for dim, part in sums.groupby("dim"):
        m = np.zeros((dim, dim))
        m[part.i, part.j] = part.m
        m[part.j, part.i] = part.m
        axes[int(dim)] = np.ascontiguousarray(np.linalg.eigh(m)[1][:, ::-1])
    return axes


def tile_links(left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float,
               same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(i, j, cosine)`` of the linked pairs of two blocks of vectors, by
    partial products with suffix-norm bounds. ``same``: one block, i < j."""
    nl, nr = (np.sqrt((x * x).sum(axis=1)) for x in (left, right))
    u, v = (left / nl[:, None]) @ axes, (right / nr[:, None]) @ axes
    suffix = [np.sqrt(np.maximum(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1], 0)) for x in (u, v)]
    rows, cols = np.arange(len(u)), np.arange(len(v))
    part = np.zeros((len(u), len(v)))
    for a in range(0, u.shape[1], AXIS_BLOCK):
        b = min(a + AXIS_BLOCK, u.shape[1])
        part += u[rows, a:b] @ v[cols, a:b].T
        if b < u.shape[1]:
            alive = part + suffix[0][rows, b][:, None] * suffix[1][cols, b][None, :] >= threshold - SLACK
        else:
            alive = part >= threshold - SLACK
        if same:
            alive &= rows[:, None] < cols[None, :]
        in_row, in_col = alive.any(axis=1), alive.any(axis=0)
        if not in_row.any():
            return np.empty(0, int), np.empty(0, int), np.empty(0)
        if in_row.mean() * in_col.mean() < 0.8 or b == u.shape[1]:
            part, alive = part[np.ix_(in_row, in_col)], alive[np.ix_(in_row, in_col)]
            rows, cols = rows[in_row], cols[in_col]
    i, j = np.nonzero(alive)
    i, j = rows[i], cols[j]
    cosine = np.empty(len(i))
    for s in range(0, len(i), 1 << 16):
        x, y = i[s:s + (1 << 16)], j[s:s + (1 << 16)]
        cosine[s:s + (1 << 16)] = np.einsum("ij,ij->i", left[x], right[y]) / (nl[x] * nr[y])
    linked = cosine >= threshold
    return i[linked], j[linked], cosine[linked]


def _tile(rows: pd.DataFrame, axes: dict[int, np.ndarray], threshold: float, block: int = BLOCK) -> pd.DataFrame:
    """Links per node and a spanning forest per tile of two parts (or of one
    part with itself)."""
    side = rows["side"].to_numpy()
    same = bool((side == 2).any())
    first, second = (rows, rows) if same else (rows[side == 0], rows[side == 1])
    if not len(first) or not len(second):
        return pd.DataFrame({"a": [], "b": [], "links": []})
    left, right = (_scaled(np.array(x["vector"].tolist(), np.float64)) for x in (first, second))
    ids_l, ids_r = first["node"].to_numpy(), second["node"].to_numpy()
    many_l, many_r = first["many"].to_numpy(), second["many"].to_numpy()
    links_l, links_r = np.zeros(len(left)), np.zeros(len(right))
    out_a, out_b = [], []
    for s in range(0, len(left), block):
        for t in range(s if same else 0, len(right), block):
            u, v = left[s:s + block], right[t:t + block]
            one = same and s == t
            i, j, _ = tile_links(u, v, axes[u.shape[1]], threshold, one)
            links_l[s:s + block] += np.bincount(i, weights=many_r[t + j], minlength=len(u))
            links_r[t:t + block] += np.bincount(j, weights=many_l[s + i], minlength=len(v))
            if len(i) > len(u) + len(v):
                table = np.zeros((len(u), len(v)), bool)
                table[i, j] = True
                if one:
                    table |= table.T
                i, j = forest(u, v, lambda r, c, table=table: table[np.ix_(r, c)])
            out_a.append(ids_l[s + i])
            out_b.append(ids_r[t + j])
    at_l, at_r = np.flatnonzero(links_l), np.flatnonzero(links_r)
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    return pd.DataFrame({
        "a": np.concatenate((ids_l[at_l], ids_r[at_r], a)),
        "b": pd.array(np.concatenate((np.full(len(at_l) + len(at_r), -1), b)), "Int64"),
        "links": np.concatenate((links_l[at_l], links_r[at_r], np.full(len(a), -1))).astype(np.int64)})


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    may = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # equal vectors of a label are one node; its number is fixed by the staging
    nodes = stage(rows.where(may).select("label", "vector", "vec_id").distinct()
                  .groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("many"))
                  .withColumns({"dim": F.size("vector"), "node": F.monotonically_increasing_id()}), "vectors")
    axes = principal_axes(nodes)
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold)) * (1 + 1e-9)) + 1e-9
    shared = nodes.sparkSession.sparkContext.broadcast(axes)  # length**2 numbers per vector length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(4))
            cells = np.zeros((batch.num_rows, CELL_AXES), np.int32)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                u, _ = _units(batch.column(1).take(pa.array(at)))
                k = min(CELL_AXES, dim)
                cells[at, :k] = np.floor(u @ shared.value[dim][:, :k] / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[:, 0]), pa.array(cells[:, 1])],
                                             names=[*batch.schema.names, "c0", "c1"])

    label_type = dict(rows.dtypes)["label"]
    placed = nodes.select("label", "vector", "node", "many", "dim").mapInArrow(
        place, f"label {label_type}, vector array<double>, node long, many long, dim int, c0 int, c1 int")
    placed = stage(placed, "vector-cells")
    cell = ["label", "dim", "c0", "c1"]
    held = F.greatest(F.lit(block), F.lit(HELD_BYTES) / 8 / F.col("dim"))   # vectors of a part
    cells = stage(placed.groupBy(*cell).agg(F.count("*").alias("n"))
                  .select(*cell, F.ceil(F.col("n") / held).cast("int").alias("cuts")), "vector-cuts")
    # half of the neighbours, so that each pair of cells comes once
    steps = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    around = (cells.select(*cell, "cuts", F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])).alias("s"))
              .select("label", "dim", F.col("c0").alias("p0"), F.col("c1").alias("p1"), F.col("cuts").alias("p_cuts"),
                      (F.col("c0") + F.col("s.x")).alias("c0"), (F.col("c1") + F.col("s.y")).alias("c1"),
                      ((F.col("s.x") == 0) & (F.col("s.y") == 0)).alias("own"))
              .join(cells, cell))
    pairs = (around.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("p_cuts") - 1)))
             .withColumn("q", F.explode(F.sequence(F.when(F.col("own"), F.col("p")).otherwise(0), F.col("cuts") - 1))))
    tile = F.struct("p0", "p1", "p", "c0", "c1", "q").alias("tile")
    alone = F.col("own") & (F.col("p") == F.col("q"))
    needs = (pairs.select("label", "dim", tile, alone.alias("alone"), F.explode(F.when(alone, F.array(
        F.struct(F.lit(2).alias("side"), F.col("p0").alias("c0"), F.col("p1").alias("c1"), F.col("p").alias("cut"))))
        .otherwise(F.array(
            F.struct(F.lit(0).alias("side"), F.col("p0").alias("c0"), F.col("p1").alias("c1"), F.col("p").alias("cut")),
            F.struct(F.lit(1).alias("side"), F.col("c0").alias("c0"), F.col("c1").alias("c1"), F.col("q").alias("cut"))))).alias("n"))
        .select("label", "dim", "tile", "n.side", "n.c0", "n.c1", "n.cut"))
    cut_rows = placed.join(cells, cell).withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")).drop("cuts")
    tiles = cut_rows.join(needs, [*cell, "cut"]).select("label", "dim", "tile", "side", "node", "many", "vector")
    found = stage(tiles.groupBy("label", "dim", "tile").applyInPandas(
        lambda part: _tile(part, shared.value, threshold, block), "a long, b long, links long"), "vector-links")
    links = found.where("links >= 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    component = connected_components(found.where("links < 0").select("a", "b"))
    grouped = stage(nodes.select("node", "least", "many").join(component, "node", "left")
                    .withColumn("component", F.coalesce("component", "node")), "vector-groups")
    # staged, so that the join deals both sides anew and a large group can be split
    first = stage(grouped.groupBy("component").agg(F.min("least").alias("first")), "vector-first")
    known = grouped.join(first, "component").join(links, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"), F.col("first").alias("component"))
    named = stage(nodes.select("label", "vector", "node").join(known, "node").drop("node"), "vector-names")
    linked = rows.where(may).join(named, ["label", "vector"]).select("vec_id", "links", "component")
    alone_rows = rows.where(~may).select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component"))
    return linked.unionAll(alone_rows).select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"))


__all__ = ["near_vectors", "principal_axes", "tile_links", "usable", "THRESHOLD", "BLOCK"]
