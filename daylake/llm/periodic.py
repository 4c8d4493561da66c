"""Periodic run detection (13): seed and extend along diagonals.

A run is a stretch of consecutive words with smallest period q and at least
``max(6, 4 q)`` words that neither neighbouring word extends. Such a run
matches itself at lag q over at least ``max(6 - q, 3 q)`` words, so for the
periods of one octave, 2^j <= q < 2^(j+1), every run holds a k-gram of k = 3 *
2^j words (5 for q = 1) that occurs again q words on: the minimum guaranteed
overlap. The k-grams of a document are indexed by exact names, built by
doubling (the name of 2^(m+1) words is the pair of names of its halves; names
that occur once in their document drop out, so plain text is gone after two or
three rounds).

Only neighbouring occurrences of a k-gram are paired. That loses nothing: k >=
q, so an occurrence between, d < q words on, would give k + d consecutive words
the periods d and q, hence (Fine and Wilf) their greatest common divisor, and
q would not be the run's smallest period. By the same argument an extended
seed has no smaller period. A table of the furthest position covered per lag
skips the other seeds of a diagonal that has been extended.

``plant`` applies the fixed rewriting of the query's contract before the search.

Results by case: a NULL text has no words; without runs the best run's columns
are NULL and the digests those of the empty list and of the words joined; a
NULL id is never rewritten; equal rows are judged one by one; an empty table
gives no rows; extra columns are ignored. A text is never cut.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.words import Words, slabs

MIN_LENGTH, MIN_PERIODS = 6, 4
SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per key, and whether the key occurs more than once."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts[names] > 1


def _paired(names: np.ndarray, at: np.ndarray, step: int, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``at`` whose gram is followed, ``step`` words on in the same
    text, by another that repeats; and the keys of both together."""
    at = at[at + step < end[at]]
    at = at[names[at + step] >= 0]
    return at, names[at] * (len(names) + 1) + names[at + step]


def seeds(ids: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(positions, lags)`` per octave of periods: a k-gram at a position
    occurs again ``lag`` words on. ``end`` is the end of each word's text."""
    total = len(ids)
    names = np.full(total, -1, np.int64)
    got, again = _named(end * (int(ids.max(initial=0)) + 1) + ids)
    at = np.flatnonzero(again)
    names[at] = got[at]
    size, octave = 1, 0
    while len(at):
        want = 4 if octave == 0 else 2 << octave
        while size < want and len(at):
            at, keys = _paired(names, at, size, end)
            got, again = _named(keys)
            names = np.full(total, -1, np.int64)
            at, got = at[again], got[again]
            names[at] = got
            size *= 2
        if len(at):
            found, keys = _paired(names, at, 1 if octave == 0 else 1 << octave, end)
            order = np.argsort(keys, kind="stable")
            a, b = order[:-1], order[1:]
            lag = found[b] - found[a]
            hit = (keys[a] == keys[b]) & (lag >= 1 << octave) & (lag < 2 << octave)
            if hit.any():
                yield found[a][hit], lag[hit]
        octave += 1


def _agree(ids: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many words match from positions ``a`` and ``b`` on (``step`` 1) or
    back (``step`` -1), ``most`` at most; compared in growing blocks."""
    done, block = 0, 64
    while done < most:
        n = min(block, most - done)
        if step > 0:
            differ = ids[a + done:a + done + n] != ids[b + done:b + done + n]
        else:
            differ = (ids[a - done - n + 1:a - done + 1] != ids[b - done - n + 1:b - done + 1])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, block = done + n, block * 2
    return done


def find_runs(ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, positions over all texts;
    text ``k`` has the words ``first[k]:first[k + 1]``."""
    end = np.repeat(first[1:], np.diff(first))
    begin = np.repeat(first[:-1], np.diff(first))
    out = []
    for at, lags in seeds(ids, end):
        order = np.lexsort((at, lags))
        at, lags = at[order], lags[order]
        covered: dict[int, int] = {}    # lag -> furthest position extended to
        k = 0
        while k < len(at):
            i, lag = int(at[k]), int(lags[k])
            if i < covered.get(lag, 0):
                # on to the lag's first seed that is not covered
                k += int(np.searchsorted(at[k:np.searchsorted(lags, lag, side="right")], covered[lag]))
                continue
            lo = i - _agree(ids, i - 1, i - 1 + lag, i - int(begin[i]), -1)
            hi = i + _agree(ids, i, i + lag, int(end[i]) - lag - i, 1)
            covered[lag] = max(hi, i + 1)
            if hi + lag - lo >= max(MIN_LENGTH, MIN_PERIODS * lag):
                out.append((lo, hi + lag - lo, lag))
            k += 1
    return out


def plant(doc_id: int, n: int) -> tuple[int, int] | None:
    """``(a, p)`` of the contract's rewriting (each word i >= a becomes word
    a + (i - a) % p), or None if the document stays as it is."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _slab(doc_ids: list, column: pa.Array, rewrite: bool) -> list[list]:
    words = Words(column)
    ids, first = words.ids.copy(), words.first
    moved: dict[int, np.ndarray] = {}       # text -> the word now at each place
    if rewrite:
        for k, name in enumerate(doc_ids):
            n = int(words.counts[k])
            if name is not None and (spot := plant(name, n)):
                a, p = spot
                place = np.arange(n)
                place[a:] = a + (place[a:] - a) % p
                moved[k] = first[k] + place
                ids[first[k]:first[k + 1]] = ids[moved[k]]

    runs: list[list[tuple[int, int, int]]] = [[] for _ in doc_ids]
    stays = np.ones(len(ids), bool)
    for start, length, period in find_runs(ids, first):
        k = int(words.owner[start])
        runs[k].append((start - int(first[k]), length, period))
        stays[start + period:start + length] = False

    # all kept words with one space behind each, text after text
    text, keep = words.raw.copy(), words.is_word.copy()
    text[words.ends] = 0x20
    keep[words.ends] = True
    step = np.diff(np.concatenate(([True], stays, [True])).view(np.int8))
    for a, b in zip(np.flatnonzero(step == -1), np.flatnonzero(step == 1)):
        keep[words.starts[a]:words.ends[b - 1] + 1] = False
    before = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    bounds, text = before[words.texts].tolist(), memoryview(text[keep])

    rows: list[list] = []
    for k, found in enumerate(runs):
        if k in moved:
            lo, hi = int(first[k]), int(first[k + 1])
            collapsed = b" ".join([words.word(w) for w in moved[k][stays[lo:hi]]])
        else:
            collapsed = text[bounds[k]:max(bounds[k], bounds[k + 1] - 1)]
        found.sort(key=lambda r: (r[0], r[2]))
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        rows.append([len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()])
    return rows


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: bool = False) -> DataFrame:
    """Per document its id, the number of runs, the run of the greatest
    exponent, a digest of all runs and one of the text without repeats."""
    kind = docs.schema[doc_id].dataType.simpleString()
    types = [pa.int64()] * 5 + [pa.string()] * 2
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slabs(batch.column(1)):
                part = batch.slice(a, b - a)
                rows = _slab(part.column(0).to_pylist(), part.column(1), rewrite)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=["id", *names])

    return (docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", doc_id))


__all__ = ["periodic_runs", "find_runs", "seeds", "plant"]
