"""Substring dedup (2): line or paragraph hashing.

A text is cut into units: ``line``, ``paragraph`` (blank-line separated) or
``sentence`` (finds a repeated passage that sits inside a longer line). A unit
is normalised (lower case, words of letters and digits joined by one space)
and hashed (128 bits). Digests are grouped over the whole table; the earliest
ranked occurrence (smallest ``doc_id``, NULL last, then smallest offset)
stays, all others are removed, and every removal keeps its character offsets
in the original text.

``sentence`` units overlap. A line has a cut at either end, at every clause
(``, ; : . ! ? …``) and, in each ``REACH`` neighbouring word gaps without one,
where the two words around the gap hash lowest; so cuts depend on the words
near them alone, and copies of a passage are cut alike whatever stands before
or after them, with or without marks. A unit goes from each cut to the first
one ``min_words`` or more words on, and from the last one ``min_words`` or
more words back to each cut: of a shared passage all from its first to its
last common cut is removed if these are ``min_words`` apart. What is lost are
words at either end, up to the next common cut. Within a text occurrences of
one digest that overlap count as one, so that a text which repeats itself
keeps its first copy.

Units of fewer than ``min_words`` words are never removed on their own, so
short common phrases of clean texts stay.

The grouping is a min-aggregate, which combines before the shuffle, so a line
that a third of all rows holds sends one row per task. Only digests seen more
than once are joined with their occurrences: the few that hold more than a
1 / ``HOT`` share of all units (so at most ``HOT`` of them) by broadcast, where
no key gathers in a task, all others by a shuffle join.

Defined results: NULL text has no units. Rows with the same ``doc_id`` (also
all with NULL) are one document of which a unit at one offset counts once, so
repeated rows keep or lose the same spans. A word that is removed has an equal
copy in the same unit of an earlier occurrence; where units overlap, a part of
that occurrence may itself be the copy of a still earlier one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daylake.llm.common import stage

UNITS = {
    "line": re.compile(r"[^\n]+"),
    "paragraph": re.compile(r"\S(?:(?!\n[ \t]*\n).)*", re.S),
}
WORD = re.compile(r"[^\W_]+")
MARK = re.compile(r"[,;:.!?…，、；：。！？]")
MIN_WORDS = 8
REACH = 12
HOT = 1000
SPAN = "start int, end int, words int, digest binary"


def _digest(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()


def _cuts(line: str, at: int) -> tuple[list[str], list[int], list[int], list[int]]:
    """``(words, cuts, starts, ends)`` of a line that starts at offset ``at``:
    a cut ``k`` stands before word ``k``; a unit that starts (ends) there
    starts (ends) at that offset."""
    found = list(WORD.finditer(line))
    words = [m.group().lower() for m in found]
    cuts = [0]
    for k in range(1, len(words) + 1):
        if k < len(words):
            a, b = found[k - 1].end(), found[k].start()
            if b - a == 1 and (line[a] == " " or line[a - 1].isdigit() and line[b].isdigit()) \
                    or not MARK.search(line, a, b):
                continue
        low, gaps = cuts[-1] + 1, k - cuts[-1] - 1
        if gaps >= REACH:
            order = [crc32(f"{words[j - 1]} {words[j]}".encode()) for j in range(low, k)]
            cuts += sorted({low + min(range(j, j + REACH), key=order.__getitem__) for j in range(gaps - REACH + 1)})
        cuts.append(k)
    starts, ends = [at + len(line) - len(line.lstrip())], [at]
    for k in cuts[1:-1]:
        a, b = found[k - 1].end(), found[k].start()
        gap = line[a:b]  # marks belong to the word they stand at
        tight = len(gap.split(None, 1)[0]) if gap and not gap[0].isspace() else 0
        ends.append(at + a + tight)
        starts.append(at + b - (len(gap.rsplit(None, 1)[-1]) if tight < len(gap) and not gap[-1].isspace() else 0))
    return words, cuts, [*starts, at + len(line)], [*ends, at + len(line.rstrip())]


def units(text: str, unit: str, min_words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """``(start, end, words, digest)`` of the units of ``min_words`` or more."""
    if unit != "sentence":
        for m in UNITS[unit].finditer(text):
            words = WORD.findall(m.group().lower())
            if len(words) >= min_words:
                yield m.start(), m.end(), len(words), _digest(words)
        return
    last: dict[bytes, int] = {}
    for m in UNITS["line"].finditer(text):
        words, cuts, starts, ends = _cuts(m.group(), m.start())
        if len(words) < min_words:
            continue
        size = len(cuts)
        spans = {(k, e) for k in range(size) if (e := bisect_left(cuts, cuts[k] + min_words)) < size}
        spans |= {(b, k) for k in range(size) if (b := bisect_right(cuts, cuts[k] - min_words) - 1) >= 0}
        for b, e in sorted(spans):
            digest = _digest(words[cuts[b]:cuts[e]])
            if last.get(digest, 0) <= starts[b]:
                last[digest] = ends[e]
                yield starts[b], ends[e], cuts[e] - cuts[b], digest


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "sentence",
                min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit: ``doc_id, start, end, words, digest``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                few = batch.slice(s, 256)
                found = [list(units(t, unit, min_words)) if t else [] for t in few.column(1).to_pylist()]
                owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
                flat = [x for own in found for x in own]
                start, end, words, digest = zip(*flat) if flat else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [few.column(0).take(pa.array(owner, pa.int64())), pa.array(start, pa.int32()),
                     pa.array(end, pa.int32()), pa.array(words, pa.int32()), pa.array(digest, pa.binary())],
                    names=["doc_id", "start", "end", "words", "digest"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id long, {SPAN}")


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "sentence",
             min_words: int = MIN_WORDS) -> DataFrame:
    """The units to remove: ``doc_id, start, end, words, digest`` and the kept
    occurrence's ``first_doc_id, first_start``."""
    found = stage(occurrences(docs, doc_id, text, unit, min_words), "units")  # read for the groups and the join
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("start").alias("at"))
    # more than one occurrence exactly if the earliest and the latest differ
    repeated = stage(found.groupBy("digest")
                     .agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count("*").alias("n"))
                     .where("first <> last or first.id is null")
                     .select("digest", F.col("first.id").alias("first_doc_id"),
                             F.col("first.at").alias("first_start"), "n"), "units-repeated")
    # at most HOT digests can hold a 1 / HOT share of the units or more
    limit = max(1, found.count() // HOT)
    hot = F.broadcast(repeated.where(F.col("n") > limit).drop("n"))
    rest = repeated.where(F.col("n") <= limit).drop("n")
    joined = found.join(hot, "digest").unionByName(
        found.join(hot.select("digest"), "digest", "left_anti").join(rest, "digest"))
    return (joined.where(~(F.col("doc_id").eqNullSafe(F.col("first_doc_id")) & (F.col("start") == F.col("first_start"))))
            .select("doc_id", "start", "end", "words", "digest", "first_doc_id", "first_start"))


def remove(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of ``text``; ``removed`` lists them by
    their offsets in the original text, overlapping ones as one (NULL if none)."""
    order = Window.partitionBy("__id").orderBy("start", "end")
    cut = (spans.select(F.col("doc_id").alias("__id"), "start", "end").distinct()
           .withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
           .withColumn("run", F.count(F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach")), 1)).over(
               order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
           .groupBy("__id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
           .groupBy("__id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed")))
    joined = docs.drop("removed").join(cut, F.col(doc_id).eqNullSafe(F.col("__id")), "left").drop("__id")
    # the text between removed spans, left to right; substring counts code points
    fields = F.col("removed")
    steps = F.aggregate(
        fields, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(F.concat(acc["out"], F.substr(F.col(text), acc["at"] + F.lit(1), s["start"] - acc["at"])).alias("out"),
                                s["end"].alias("at")),
        lambda acc: F.concat(acc["out"], F.substr(F.col(text), acc["at"] + F.lit(1))))
    return joined.withColumn(text, F.when(fields.isNull() | F.col(text).isNull(), F.col(text)).otherwise(steps))


__all__ = ["units", "occurrences", "removals", "remove", "MIN_WORDS"]
