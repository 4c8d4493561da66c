"""Benchmark decontamination (6): q-gram lemma filtering.

A benchmark item of m bytes occurs in a document if some stretch of it is
within k = ``EDITS`` * m edits of the item (lower-cased, Unicode white space
collapsed). By the q-gram lemma such a stretch shares at least
m - q + 1 - k q of the item's q-grams, all on k + 1 neighbouring diagonals
(text position minus item position). So: every q-gram of the whole text is
looked up among the items' q-grams, hits are counted per item in bands of
diagonals that overlap by k, bands that reach the bound are kept, and each is
verified by a banded alignment with free ends in the text.

Items are taken in blocks of about ``BLOCK_BYTES``, so what a task holds is
bounded whatever the number of items (some 30 bytes an item byte); documents are
read once a block. Long texts are walked in pieces of at least twice the longest
item, which overlap by it, so no item is lost at a cut.

Defined results: NULL and empty texts match nothing. Items under ``SHORT`` bytes
match verbatim only, and only between word boundaries; NULL and empty items and
those under ``q`` bytes match nothing: they share no q-gram with any text. An
item whose id is NULL matches like any other and is listed with NULL, unless an
item of the same text has an id. A repeated row matches like the first. ``q``
counts bytes of UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import stage
from daylake.llm.features import PIECE, pieces

Q, EDITS, SHORT = 12, 0.05, 40
BLOCK_BYTES = 4 << 20
_SPACES = np.array([32 if b in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32) else b for b in range(256)], np.uint8)
_WIDE_SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: np.ndarray) -> np.ndarray:
    """A 64-bit code of every q-gram (12 bytes: two overlapping 8-byte words)."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    words = np.ndarray((n + Q - 8,), "<u8", np.ascontiguousarray(text), strides=(1,))
    return words[:n] * _MIX ^ words[Q - 8:Q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)


def _folded(column: pa.Array) -> pa.Array:
    """Lower case, the final sigma as any other, white space beyond ASCII as
    spaces: for items and documents alike."""
    return pc.replace_substring(pc.utf8_lower(pc.replace_substring_regex(column, _WIDE_SPACE, " ")), "ς", "σ")


def normal(text: str | None) -> bytes:
    raw = np.frombuffer(_folded(pa.array([text or ""]))[0].as_py().encode(), np.uint8)
    return b" ".join(_SPACES[raw].tobytes().split())


class Items:
    """A block of benchmark items and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        known = [(i, t) for i, t in ((i, normal(t)) for i, t in items) if len(t) >= Q]
        named = {t for i, t in known if i is not None}
        known = [(i, t) for i, t in known if i is not None or t not in named]
        self.ids = [i for i, _ in known]
        self.texts = [np.frombuffer(t, np.uint8) for _, t in known]
        size = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.where(size < SHORT, 0, np.minimum((EDITS * size).astype(np.int64), (size - Q) // Q))
        self.need = size - Q + 1 - self.edits * Q
        self.band = 1 << np.ceil(np.log2(self.edits + 2)).astype(np.int64)
        codes = [_codes(t) for t in self.texts]
        all_codes = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])
        at = np.concatenate([np.arange(len(c), dtype=np.int32) for c in codes]) if codes else np.empty(0, np.int32)
        order = np.argsort(all_codes, kind="stable")
        self.item, self.at = item[order], at[order]
        self.codes, self.first, self.n = np.unique(all_codes[order], return_index=True, return_counts=True)
        # a sixteenth of the table is taken at most
        self.table_bits = np.uint64(max(16, 4 + int(len(self.codes)).bit_length()))
        self.table = np.zeros(1 << int(self.table_bits), bool)
        self.table[self._slot(self.codes)] = True
        self.longest = int(size.max() + self.edits.max()) if len(size) else 0

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * _MIX >> (np.uint64(64) - self.table_bits)).astype(np.int64)

    def candidates(self, text: np.ndarray) -> list[tuple[int, int, int]]:
        """``(item, first diagonal, last diagonal)`` of the bands that reach
        the bound."""
        if not len(self.codes):
            return []
        codes = _codes(text)
        at = np.flatnonzero(self.table[self._slot(codes)])
        if not len(at):
            return []
        found = np.searchsorted(self.codes, codes[at])
        found[found == len(self.codes)] = 0
        real = self.codes[found] == codes[at]
        at, found = at[real], found[real]
        times = self.n[found]
        base = np.repeat(self.first[found] - (np.cumsum(times) - times), times)
        entry = base + np.arange(times.sum())
        item = self.item[entry].astype(np.int64)
        diagonal = np.repeat(at, times) - self.at[entry] + self.longest  # not below 0
        width, edits = self.band[item], self.edits[item]
        bin_, rest = np.divmod(diagonal, width)
        over = (rest < edits) & (bin_ > 0)  # the band before reaches this far
        stride = np.int64(len(text) + 2 * self.longest + 2)
        keys, counts = np.unique(np.concatenate((item * stride + bin_, item[over] * stride + bin_[over] - 1)),
                                 return_counts=True)
        item, bin_ = np.divmod(keys, stride)
        keep = counts >= self.need[item]
        item, bin_ = item[keep], bin_[keep]
        low = bin_ * self.band[item] - self.longest
        return list(zip(item.tolist(), low.tolist(), (low + self.band[item] + self.edits[item]).tolist()))

    def matches(self, text: np.ndarray) -> dict[int, int]:
        """Index and least edits found of each item that occurs in ``text``."""
        out: dict[int, int] = {}
        for item, low, high in self.candidates(text):
            if len(self.texts[item]) < SHORT:
                edits = verbatim(self.texts[item], text, low, high)
            else:
                edits = align(self.texts[item], text, low, high, int(self.edits[item]))
            if edits is not None and edits < out.get(item, 1 << 30):
                out[item] = edits
        return out


def verbatim(item: np.ndarray, text: np.ndarray, low: int, high: int) -> int | None:
    """0 if the item stands on one of the diagonals between word boundaries."""
    begin = max(0, low)
    region, own = text[begin:max(0, high + len(item))].tobytes(), item.tobytes()
    in_word = lambda k: 0 <= k < len(text) and (text[k] >= 0x80 or chr(text[k]).isalnum())
    at = region.find(own)
    while at >= 0:
        a, b = begin + at, begin + at + len(own)
        if not (in_word(a - 1) and in_word(a)) and not (in_word(b - 1) and in_word(b)):
            return 0
        at = region.find(own, at + 1)
    return None


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> int | None:
    """Least edits between the item and a stretch of ``text`` whose path stays
    on the diagonals ``low - most`` to ``high + most``; None above ``most``."""
    low, high = low - most, high + most
    region = text[max(0, low):max(0, high + len(item))]
    if region.tobytes().find(item.tobytes()) >= 0:
        return 0
    width = high - low + 1
    # cell c of row i stands for text position i + low + c (characters used)
    steps = np.arange(width)
    big = len(item) + len(text) + 1
    padded = np.zeros(len(item) + width + 2, np.int16) - 1
    lo = max(0, low)
    hi = min(len(text), low + len(item) + width + 2)
    if hi > lo:
        padded[lo - low:hi - low] = text[lo:hi]
    position = low + steps
    row = np.where((position >= 0) & (position <= len(text)), 0, big)
    for i in range(1, len(item) + 1):
        # diagonal: text byte before position i + low + c
        match = row + (padded[i - 1:i - 1 + width] != item[i - 1])
        skip = np.append(row[1:], big) + 1  # item byte without a text byte
        best = np.minimum(match, skip)
        position = low + i + steps
        best[(position < 0) | (position > len(text))] = big
        row = np.minimum.accumulate(best - steps) + steps  # text bytes without an item byte
        if row.min() > most:
            return None
    return int(row.min())


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    """The items in blocks of at most ``BLOCK_BYTES`` (or one longer item)."""
    items = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")) \
        .where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cuts = -(-int(total) // (BLOCK_BYTES // 2)) or 1
    ordered = lambda rows: sorted(((r.id, r.text) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    if cuts == 1:
        yield Items(ordered(items.collect()))
        return
    dealt = stage(items.withColumn("cut", F.pmod(F.xxhash64("text"), F.lit(cuts))), "benchmark")
    for cut in range(cuts):
        yield Items(ordered(dealt.where(F.col("cut") == cut).collect()))


def _found(column: pa.Array, items: Items) -> dict[int, dict[int, int]]:
    """Matches by row of a text column."""
    out: dict[int, dict[int, int]] = {}
    if not len(column) or not items.texts:
        return out
    overlap = items.longest + Q
    for part, owner, starts in pieces(_folded(column.fill_null("") if column.null_count else column), _SPACES, 32,
                                      (overlap + 1,), size=max(PIECE, 2 * overlap)):
        ends = np.append(starts[1:], len(part))
        codes = _codes(part)
        # one look at the whole run: most texts hold too few q-grams of the items
        hits = np.flatnonzero(items.table[items._slot(codes)])
        n_hits = np.searchsorted(hits, ends) - np.searchsorted(hits, starts)
        least = int(items.need.min())
        few = n_hits >= least
        for who, a, b in zip(owner[few].tolist(), starts[few].tolist(), ends[few].tolist()):
            for item, edits in items.matches(part[a:b]).items():
                own = out.setdefault(who, {})
                own[item] = min(edits, own.get(item, 1 << 30))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that occurs in it: ``doc_id, item_id,
    edits, item_bytes``."""
    out = None
    for items in _blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own: Items = shared.value
            for batch in batches:
                rows = [(k, own.ids[i], e, len(own.texts[i]))
                        for k, hits in _found(batch.column(1), own).items() for i, e in sorted(hits.items())]
                k, ids, edits, size = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(k, pa.int64())), pa.array(ids, pa.int64()),
                     pa.array(edits, pa.int32()), pa.array(size, pa.int32())],
                    names=["doc_id", "item_id", "edits", "item_bytes"])

        part = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
            run, "doc_id long, item_id long, edits int, item_bytes int")
        out = part if out is None else out.unionAll(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds an item."""
    at = docs.columns.index(text)
    for items in _blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = np.zeros(batch.num_rows, bool)
                hit[list(_found(batch.column(at), shared.value))] = True
                yield batch.filter(pa.array(~hit))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


__all__ = ["Items", "align", "normal", "contamination", "drop_contaminated", "Q", "EDITS", "SHORT"]
