"""Spelling variant grouping (12): blocked Gram matrices.

1. ``vocabulary``: the distinct words with their counts, counted per task
   before the shuffle.
2. ``near_pairs``: two words one edit apart have letter counts at most 2 apart
   in squared distance: one letter for another changes two counts by one, an
   insertion one. Words are blocked by length and, to keep blocks small
   however large the vocabulary, by how many of their letters fall in each of
   a few letter groups of about equal weight (``letter_groups``); one edit moves
   at most one letter from one group to another, so a block meets itself and a
   fixed set of neighbour blocks, of its own and the next length. Per block the
   squared distances come from NumPy matrix products, |a|^2 + |b|^2 - 2 a.b;
   pairs of at most 2 are verified letter by letter. Nothing is left out: the
   groups only say which blocks are multiplied.
3. ``variant_forms``: near words per word are counted and the best one kept by
   aggregates that combine before the shuffle; a chain of forms is followed by
   pointer doubling (a form's count is ten times the word's, so a chain is no
   longer than the digits of a 64-bit count).

Large blocks are cut into tiles by hash, both the block's own words (``OWN``)
and its visitors (``VISITORS``), so no task holds more than two tiles.

Results by case: NULL and empty texts have no words; a NULL id is written as
the empty text before the colon; rows that share an id count each; ties between
forms go to the smaller word in code-point order; an empty table gives no
rows; extra columns are ignored. Words of any length are compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import stage

MIN_POINTS, MIN_COUNT = 7, 2
DROP_EVERY = 31
RATIO = 10
HELD = 500_000              # words a task counts before it passes them on
OWN, VISITORS = 2_048, 8_192
BLOCK_WORDS = 1_024         # words a block should hold, from which the number of groups follows
LETTERS = 90                # a-z and U+00C0-U+00FF
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_POINTS)
DOUBLINGS = 5               # 2^5 steps; a chain has at most 19

# code of each Latin-1 byte of a word
_CODE = np.zeros(256, np.uint8)
_CODE[ord("a"):ord("z") + 1] = np.arange(26)
_CODE[0xC0:0x100] = 26 + np.arange(64)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: the words of at least ``MIN_POINTS`` code points found
    ``MIN_COUNT`` times or more, after the contract's deletions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        total: Counter = Counter()
        crc32, found = zlib.crc32, RUN.findall
        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1)):
                raw = body.as_py()
                if not raw:
                    continue
                before = crc32(f"{'' if name.as_py() is None else name.as_py()}:".encode())
                for word, n in Counter(found(raw.lower().decode())).items():
                    h = crc32(word.encode(), before)
                    if h % DROP_EVERY == 0:
                        if len(word) == MIN_POINTS:
                            continue
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    total[word] += n
                if len(total) > HELD:
                    yield out()
                    total.clear()
        yield out()

    parts = (docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
             .mapInArrow(run, "word string, n long"))
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words end to end as codes, and the word lengths."""
    joined = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return _CODE[joined], np.fromiter(map(len, words), np.int64, len(words))


def _letter_counts(words: list[str]) -> np.ndarray:
    codes, lengths = _codes(words)
    row = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(row * LETTERS + codes, minlength=len(words) * LETTERS).reshape(-1, LETTERS)


def letter_groups(words: DataFrame, n_words: int) -> np.ndarray:
    """The group of each letter: as many groups of about equal weight as bring
    blocks down to ``BLOCK_WORDS`` words. Reads one sum per letter."""
    groups, blocks = 1, 8.0
    while n_words / blocks > BLOCK_WORDS and groups < 16:
        groups, blocks = groups + 1, blocks * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS, np.int64)
        for batch in batches:
            codes, _ = _codes(batch.column(0).to_pylist())
            total += np.bincount(codes, minlength=LETTERS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LETTERS)), pa.array(total)], names=["letter", "n"])

    rows = words.select("word").mapInArrow(run, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    weights = np.zeros(LETTERS, np.int64)
    for letter, n in rows.collect():
        weights[letter] = n
    group, load = np.zeros(LETTERS, np.int64), np.zeros(groups, np.int64)
    for letter in np.argsort(-weights, kind="stable"):
        group[letter] = load.argmin()
        load[group[letter]] += weights[letter]
    return group


def _edits(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows are one edit apart; letters per row, ``long`` as wide as
    ``short`` or one wider."""
    width = short.shape[1]
    if long.shape[1] == width:
        return (short != long).sum(axis=1) == 1
    front = short == long[:, :width]
    back = (short == long[:, 1:])[:, ::-1]
    run = lambda same: np.where(same.all(axis=1), width, (~same).argmax(axis=1))
    return run(front) + run(back) >= width


def _matches(own: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs one edit apart; ``own`` of one length, ``others`` of the same
    or the next: products of letter-count blocks, then the check of letters."""
    a, b = _letter_counts(own), _letter_counts(others)
    used = (a.any(axis=0)) & (b.any(axis=0))
    kind = np.float32 if max(a.sum(axis=1).max(), b.sum(axis=1).max()) < 2_000 else np.float64
    square = lambda m: (m.astype(kind) ** 2).sum(axis=1)
    aa, bb = square(a), square(b)
    a, b = a[:, used].astype(kind), b[:, used].astype(kind)
    rows_a = _codes(own)[0].reshape(len(own), -1)
    rows_b = _codes(others)[0].reshape(len(others), -1)
    step = max(1, (8 << 20) // max(rows_b.shape[1], 1))     # pairs verified at a time
    got_i, got_j = [], []
    for s in range(0, len(own), 1024):
        distance = aa[s:s + 1024, None] + bb[None, :] - 2 * (a[s:s + 1024] @ b.T)
        i, j = np.nonzero(distance <= 2)
        for t in range(0, len(i), step):
            p, q = i[t:t + step] + s, j[t:t + step]
            ok = _edits(rows_a[p], rows_b[q])
            got_i.append(p[ok])
            got_j.append(q[ok])
    none = np.zeros(0, np.int64)
    return np.concatenate(got_i or [none]), np.concatenate(got_j or [none])


def _pair_block(block: pa.Table) -> pa.Table:
    """One hub: its own tile of words against a tile of visitors."""
    word, n = np.array(block["word"].to_pylist(), object), block["n"].to_numpy()
    own = block["own"].to_numpy(zero_copy_only=False)
    size = np.fromiter(map(len, word), np.int64, len(word))
    out_w, out_near, out_n = [], [], []
    mine = np.flatnonzero(own)
    if len(mine) < len(word) and len(mine):
        base = int(size[mine[0]])
        for length in (base, base + 1):
            them = np.flatnonzero(~own & (size == length))
            if not len(them):
                continue
            i, j = _matches(list(word[mine]), list(word[them]))
            i, j = mine[i], them[j]
            # a block visits itself too: of each of its pairs, one order
            inside = block["home"].to_numpy(zero_copy_only=False)[j]
            stays = ~inside | (word[i] < word[j]) if len(i) else np.zeros(0, bool)
            i, j = i[stays.astype(bool)], j[stays.astype(bool)]
            out_w += [word[i], word[j]]
            out_near += [word[j], word[i]]
            out_n += [n[j], n[i]]
    flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, object)
    return pa.table({"word": pa.array(flat(out_w).tolist(), pa.string()),
                     "near": pa.array(flat(out_near).tolist(), pa.string()),
                     "near_n": pa.array(flat(out_n).tolist(), pa.int64())})


def _neighbours(groups: int) -> list[list[int]]:
    """Steps from a block to the blocks it meets as a hub: itself, those of its
    length with one letter moved to a later group, and one letter more."""
    steps = [[0] * groups]
    for x in range(groups):
        for y in range(x + 1, groups):
            steps.append([(g == y) - (g == x) for g in range(groups)])
        steps.append([int(g == x) for g in range(groups)])
    return steps


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``: every two words one edit apart, both ways
    round. ``words`` has distinct ``word`` and ``n``, staged."""
    group = letter_groups(words, words.count())
    groups = int(group.max()) + 1

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, lengths = _codes(batch.column(0).to_pylist())
            row = np.repeat(np.arange(len(lengths)), lengths)
            counts = np.bincount(row * groups + group[codes], minlength=len(lengths) * groups)
            cell = pa.ListArray.from_arrays(pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * groups),
                                            pa.array(counts.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cell], names=["word", "n", "cell"])

    placed = stage(words.select("word", "n").mapInArrow(cells, "word string, n long, cell array<int>"), "spelling-cells")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("own_n"))
    # the hubs a block visits: back along the steps
    steps = F.array(*[F.array(*[F.lit(v) for v in step]) for step in _neighbours(groups)])
    hubs = F.transform(steps, lambda step: F.zip_with("cell", step, lambda a, b: a - b))
    visits = (sizes.withColumn("hub", F.explode(hubs))
              .join(sizes.select(F.col("cell").alias("hub"), F.col("own_n").alias("hub_n")), "hub"))
    plan = stage(visits.select("cell", "hub", "own_n", "hub_n"), "spelling-visits")
    tiles = plan.groupBy("hub").agg(
        F.ceil(F.first("hub_n") / OWN).cast("int").alias("own_tiles"),
        F.ceil(F.sum("own_n") / VISITORS).cast("int").alias("visitor_tiles"))
    ways = stage(plan.select("cell", "hub").join(tiles, "hub"), "spelling-tiles")

    spot = lambda n, seed: F.pmod(F.xxhash64("word", F.lit(seed)), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = (placed.join(ways.where(F.col("cell") == F.col("hub")).drop("cell"), placed["cell"] == F.col("hub"))
           .select("hub", spot(F.col("own_tiles"), 1).alias("i"), each(F.col("visitor_tiles")).alias("j"),
                   "word", "n", F.lit(True).alias("own"), F.lit(False).alias("home")))
    seen = (placed.join(ways, "cell")
            .select("hub", each(F.col("own_tiles")).alias("i"), spot(F.col("visitor_tiles"), 2).alias("j"),
                    "word", "n", F.lit(False).alias("own"), (F.col("cell") == F.col("hub")).alias("home")))
    return own.unionByName(seen).groupBy("hub", "i", "j").applyInArrow(
        _pair_block, "word string, near string, near_n long")


def variant_forms(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of a vocabulary."""
    best = (near_pairs(words).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"),
                 F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")))
    joined = words.join(best, "word", "left")
    takes = -F.col("best.minus_n") >= F.lit(RATIO) * F.col("n")
    formed = stage(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.minus_n")).alias("form_n")),
        "spelling-forms")
    # pointers of the words that have a form; each round doubles the steps
    hop = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        on = hop.select(F.col("word").alias("root"), F.col("root").alias("further"))
        hop = stage(hop.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
                    "spelling-roots")
        if hop.join(formed.where("form is not null").select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
            break
    return (formed.join(hop, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of ``docs`` with their forms."""
    return variant_forms(stage(vocabulary(docs, doc_id, text), "spelling-words"))


__all__ = ["spelling_variants", "variant_forms", "near_pairs", "vocabulary", "letter_groups"]
