"""Quality classifier (7): nearest-neighbour voting in a latent-semantic space.

Features: log counts of hashed n-grams over the text's character classes
(case, digits, white space, each punctuation mark) and over its lower-cased
bytes, weighted by inverse document frequency, and the shares of words that
repeat the word before, the one before that, or one of the ``NEAR`` words before
(what is over a half of the words, doubled: half is usual in good text). None of
the shares depends on a text's length. A truncated singular value decomposition
of the labelled sample gives the latent-semantic axes. The labelled vectors
(``SAMPLE`` rows at most, so a few hundred kB) are broadcast; every document
is projected and compared with all of them, block by block, by exact cosine.
The ``NEIGHBOURS`` most similar vote with their similarity as weight.

Sample: up to ``SAMPLE`` labelled rows, drawn by a hash of the id (the
documented bound); every document is scored, over its whole text.

Defined results: NULL text is empty text. A text without features (or a
model without labelled rows) gets the share of good rows in the sample
(0.5 without labels). Documents with several labels count once per label;
repeated rows come back repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from daylake.llm.features import gram_counts, pieces
from daylake.llm.words import Words

BITS = 11
SHAPE_GRAMS, BYTE_GRAMS = (1, 2, 3, 4), (3,)
EXTRA, EXTRA_WEIGHT = 3, 0.7  # shares of repeated words, beside n-grams of length 1
NEAR = 50
WIDTH = 2 * (1 << BITS) + EXTRA
SAMPLE, AXES, NEIGHBOURS = 2000, 32, 25
BLOCK = 1024


def _classes() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        out[b] = ord("a") if b >= 128 or c.islower() else ord("A") if c.isupper() else ord("0") if c.isdigit() else b
    return out


_SHAPE = _classes()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, counts)`` of a text column, some texts at a time."""
    column = column.fill_null("") if column.null_count else column
    step = 128
    for s in range(0, len(column), step):
        part = column.slice(s, step)
        total = np.zeros((len(part), WIDTH), np.float32)
        for at, codes, grams in ((0, _SHAPE, SHAPE_GRAMS), (1 << BITS, _LOWER, BYTE_GRAMS)):
            for run, owner, starts in pieces(part, codes, None, grams, pad=False):
                counts = gram_counts(run, starts, grams, BITS)
                np.add.at(total[:, at:at + (1 << BITS)], owner, counts)
        total[:, -EXTRA:] = _repeats(part)
        yield np.arange(s, s + len(part)), total


def _repeats(texts: pa.Array) -> np.ndarray:
    """Per text the shares of words that equal the word before, the one before
    that, and, as far as they are over a half, one of the ``NEAR`` before."""
    words = Words(texts)
    owner, ids, n = words.owner, words.ids, np.maximum(words.counts, 1)
    out = np.zeros((len(n), EXTRA))
    for lag in (1, 2):
        same = (ids[lag:] == ids[:-lag]) & (owner[lag:] == owner[:-lag])
        out[:, lag - 1] = np.bincount(owner[lag:][same], minlength=len(n)) / n
    key = owner * (int(ids.max(initial=0)) + 1) + ids
    order = np.argsort(key, kind="stable")
    a, b = order[:-1], order[1:]
    near = b[(key[a] == key[b]) & (b - a <= NEAR)]
    out[:, 2] = np.clip(2 * (np.bincount(owner[near], minlength=len(n)) / n - 0.5), 0, 1)
    return out


class Model:
    """Axes, weights and the labelled vectors."""

    def __init__(self, counts: np.ndarray, label: np.ndarray, axes: int = AXES) -> None:
        self.prior = float(label.mean()) if len(label) else 0.5
        self.label = label.astype(np.float32)
        df = (counts > 0).sum(axis=0)
        self.idf = (np.log((1 + len(counts)) / (1 + df)) + 1).astype(np.float32)
        x = self._weigh(counts)
        self.axes = np.zeros((counts.shape[1], 0), np.float32)
        if len(x):
            values, vectors = np.linalg.eigh((x @ x.T).astype(np.float64))
            order = np.argsort(values)[::-1][:axes]
            order = order[values[order] > 1e-8]
            self.axes = ((x.T @ vectors[:, order]) / np.sqrt(values[order])).astype(np.float32)
        self.vectors = _unit(x @ self.axes)

    def _weigh(self, counts: np.ndarray) -> np.ndarray:
        out = np.empty_like(counts)
        grams = np.log1p(counts[:, :-EXTRA], out=out[:, :-EXTRA])
        grams *= self.idf[:-EXTRA]
        grams /= _norm(grams)
        np.multiply(counts[:, -EXTRA:], EXTRA_WEIGHT, out=out[:, -EXTRA:])
        out /= _norm(out)
        return out

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        filled = counts.sum(axis=1) > 0
        if not len(self.label) or not self.axes.shape[1] or not filled.any():
            return out
        near = _unit(self._weigh(counts[filled]) @ self.axes) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, top, axis=1), 1e-6)
        out[filled] = np.clip((weight * self.label[top]).sum(axis=1) / weight.sum(axis=1), 0, 1)
        return out


def _norm(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return np.where(norm > 0, norm, 1).astype(x.dtype)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / _norm(x)


def train(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on up to ``sample`` labelled rows ``usable`` (a condition on
    ``doc_id``) allows."""
    drawn = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).where(usable)
             .select(F.col(doc_id).alias("id"), F.col(label).alias("label")).distinct()
             .orderBy(F.xxhash64("id"), "id", "label").limit(sample))
    rows = (docs.join(F.broadcast(drawn), F.col(doc_id) == F.col("id"))
            .select(F.col("id"), F.col("label").cast("double").alias("label"), F.col(text).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, counts in features(batch.column(2)):
                where = [np.flatnonzero(row) for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at[0], len(at)), batch.column(1).slice(at[0], len(at)),
                     pa.array([i.astype("<i4").tobytes() for i in where], pa.binary()),
                     pa.array([row[i].astype("<f4").tobytes() for row, i in zip(counts, where)], pa.binary())],
                    names=["id", "label", "at", "n"])

    # one sparse row per sampled document; documents that repeat an id do not
    # lengthen the sample
    got = sorted((r.row for r in rows.mapInArrow(run, "id long, label double, at binary, n binary")
                  .groupBy("id", "label").agg(F.min(F.struct("id", "label", "at", "n")).alias("row")).collect()),
                 key=lambda r: (r.id, r.label))
    counts = np.zeros((len(got), WIDTH), np.float32)
    for k, r in enumerate(got):
        counts[k, np.frombuffer(r.at, "<i4")] = np.frombuffer(r.n, "<f4")
    return Model(counts, np.array([r.label for r in got]))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The columns ``keep`` with the score, 0 to 1."""
    fields = [f for c in keep for f in docs.schema.fields if f.name == c]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            out = np.empty(batch.num_rows)
            for at, counts in features(batch.column(len(keep))):
                out[at] = m.score(counts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(out)], names=[*keep, name])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(
        run, StructType([*fields, StructField(name, DoubleType())]))


def keep_good(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below ``least``."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            out = np.empty(batch.num_rows)
            for rows, counts in features(batch.column(at)):
                out[rows] = m.score(counts)
            yield batch.filter(pa.array(out >= least))

    return docs.mapInArrow(run, docs.schema)


__all__ = ["Model", "features", "train", "score", "keep_good", "SAMPLE", "NEIGHBOURS"]
