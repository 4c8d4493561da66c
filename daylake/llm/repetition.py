"""Quality rules (11): repetition coverage.

Per document: word, symbol and line counts, the characters inside duplicated
n-grams for several n, and the characters inside duplicated lines. The n-gram
hashes roll in numpy: over all words of a slab, the hash of n words is that of
n - 1 words times a base plus the next word's number. Only windows whose two
(n - 1)-grams both repeat are looked at, so clean text drops out after the
first lengths. Windows of equal hash are compared word by word; where a hash
collides, the windows are grouped by their words instead.

``n_repeat_words`` counts the words of all windows found twice or more in the
text, the first included. The character counts leave the first occurrence out:
they are what the text says again. Overlapping windows count a character once;
characters are code points of words.

``kept`` is false if ``base_failed`` (fewer than ``MIN_WORDS`` words, or over
``MAX_REPEAT`` percent of the words in 3-word windows found twice), or if the
duplicated lines or the duplicated n-grams of any length hold more than their
percentage of the characters (``LINE_LIMIT``, ``LIMITS``).

Results by case: a NULL or empty text has no words, counts 0 and is not kept;
a NULL id stays NULL; rows that share an id or a text are judged one by one;
an empty table gives no rows; extra columns are ignored. A text is never cut:
memory is bounded by a slab (``words.SLAB_BYTES``) or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.words import Words, numbered, slabs

MIN_WORDS = 50
MAX_REPEAT = 50     # percent of the words, in repeated 3-word windows
WINDOW = 3
# Percent of the characters that duplicated n-grams may hold, by n, and
# duplicated lines: the limits published for a large web corpus.
LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_LIMIT = 20
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
          *[f"dup_chars_{n}" for n in LIMITS]]
SCHEMA = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(values: np.ndarray) -> np.ndarray:
    """64 well-spread bits a number (splitmix finaliser)."""
    x = values.astype(np.uint64) + _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _same(at: np.ndarray, n: int, keys: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Which of the windows ``at`` (ascending) occur twice or more in their
    text, and which of those are not the first."""
    twice, later = np.zeros(len(at), bool), np.zeros(len(at), bool)
    order = np.argsort(keys)
    hit = np.flatnonzero(keys[order[:-1]] == keys[order[1:]])
    some = np.unique(np.concatenate((order[hit], order[hit + 1])))
    if not len(some):
        return twice, later
    _, first, group = np.unique(keys[some], return_index=True, return_inverse=True)
    here, head = at[some], at[some[first]][group]
    equal = words.owner[here] == words.owner[head]
    for k in range(n):
        equal &= words.ids[here + k] == words.ids[head + k]
    if not equal.all():     # different windows of one hash: group by the words
        rows = np.column_stack([words.owner[here], *[words.ids[here + k] for k in range(n)]])
        _, first, group = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        group = group.reshape(-1)
    twice[some] = later[some] = np.bincount(group)[group] > 1
    later[some[first]] = False
    return twice, later


def _covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    edge = np.zeros(total + 1, np.int64)
    edge[at] += 1
    edge[at + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def duplicated(words: Words, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(n, all, later)`` per n of ``lengths`` (ascending): the words that lie
    in an n-gram found twice or more in their text, and those that lie in one
    found before in it."""
    total = len(words.starts)
    mixed = _mix(words.ids)
    left = words.first[1:][words.owner] - np.arange(total) if total else np.zeros(0, np.int64)
    salt = _mix(words.owner)
    rolled = mixed.copy()
    at = None                       # windows that may repeat; None: all
    for n in range(2, max(lengths) + 1):
        rolled = rolled[:-1] * _BASE + mixed[n - 1:] if len(rolled) > 1 else rolled[:0]
        if n < min(lengths):
            continue
        cand = np.flatnonzero(left >= n) if at is None else at[left[at] >= n]
        twice, later = _same(cand, n, rolled[cand] ^ salt[cand], words)
        again, cand = cand[later], cand[twice]
        if n in lengths:
            yield n, _covered(cand, n, total), _covered(again, n, total)
        # an (n + 1)-gram repeats only where both its n-grams do
        is_dup = np.zeros(total + 1, bool)
        is_dup[cand] = True
        at = cand[is_dup[cand + 1]]


def _per_text(texts: np.ndarray, at_byte: np.ndarray) -> np.ndarray:
    before = np.zeros(len(at_byte) + 1, np.int64)
    np.cumsum(at_byte, out=before[1:])
    return np.diff(before[texts])


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts and verdicts of one slab of texts."""
    words = Words(column)
    n_docs, raw = len(words.counts), words.raw
    points = words.points_before
    chars = points[words.ends] - points[words.starts]

    def summed(owner: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights, n_docs).astype(np.int64)

    feeds = np.flatnonzero(raw == 0x0A)
    begins = np.concatenate(([0], feeds[:-1] + 1)).astype(np.int64) if len(feeds) else feeds
    line_owner = np.searchsorted(words.texts, begins, side="right") - 1
    ends = np.zeros(len(feeds) + 1, np.int64)
    np.cumsum(feeds - begins, out=ends[1:])
    line_key = line_owner * (len(feeds) + 1) + numbered(raw[raw != 0x0A], ends)
    line_chars = points[feeds] - points[begins]
    has_word = line_chars > 0
    later = has_word.copy()
    later[np.unique(line_key, return_index=True)[1]] = False

    out = {"n_words": words.counts.astype(np.int64), "word_chars": summed(words.owner, chars),
           "n_symbols": _per_text(words.texts, np.isin(raw, np.frombuffer(SYMBOLS, np.uint8))),
           "n_dup_lines": np.bincount(line_owner[later], minlength=n_docs).astype(np.int64),
           "dup_line_chars": summed(line_owner[later], line_chars[later])}
    for n, inside, again in duplicated(words, [WINDOW, *LIMITS]):
        if n == WINDOW:
            out["n_repeat_words"] = np.bincount(words.owner[inside], minlength=n_docs).astype(np.int64)
        if n in LIMITS:
            out[f"dup_chars_{n}"] = summed(words.owner[again], chars[again])
    failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT * out["n_words"])
    kept = ~failed & (100 * out["dup_line_chars"] <= LINE_LIMIT * out["word_chars"])
    for n, limit in LIMITS.items():
        kept &= 100 * out[f"dup_chars_{n}"] <= limit * out["word_chars"]
    return {**{c: out[c] for c in COUNTS}, "base_failed": failed, "kept": kept}


def repetition(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and, per document, the counts, ``base_failed`` and ``kept``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slabs(batch.column(1)):
                got = measure(batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *map(pa.array, got.values())], names=["id", *got])

    return (docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", doc_id))


__all__ = ["repetition", "measure", "duplicated", "LIMITS", "LINE_LIMIT", "MIN_WORDS", "MAX_REPEAT"]
