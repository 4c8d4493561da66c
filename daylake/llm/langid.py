"""Language identification (4): hierarchical discrimination.

A linear support vector machine per pair of families picks the language
family; inside the family one-versus-one linear support vector machines
separate its languages, and the language with most votes (then the larger
margin) wins. Features are relative frequencies of hashed byte n-grams of the
lower-cased text with everything but letters as one space, so a text's
margins are means of per-gram weights over the whole text.

Training: a sample of labelled documents, drawn by a hash of the id, bounded
whatever the labels hold: the ``MAX_LANGUAGES`` labels of most documents, up to
``PER_LANGUAGE`` documents of each and ``MAX_ROWS`` in all. Rarer labels are not
learned. Everything else runs over all documents. The family of a language is
read from ``FAMILIES``; languages not listed are grouped into families of up to
``FAMILY_SIZE`` by the likeness of their mean features, so that the machines grow
with the languages and not with their square.

Defined results: a NULL text or one without letters is ``und`` with score 0.
Without labelled rows every text is ``und``. Repeated rows come back
repeated; ids may be NULL (then never labelled for training).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from daylake.llm.features import gram_counts, gram_sums, pieces

GRAMS, BITS = (2, 3, 4), 14
PER_LANGUAGE, MAX_LANGUAGES, MAX_ROWS = 250, 100, 8_000
FAMILY_SIZE = 8
UNKNOWN = "und"
# Language codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt"),
    "turkic": ("tr", "az", "kk"),
    "indic": ("hi", "bn", "ur", "mr"),
}
_SPACE = ord(" ")
_CODES = np.array([b if b >= 128 or chr(b).isalpha() else _SPACE for b in range(256)], np.uint8)
_LETTER = r"\p{L}"


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30) -> tuple[np.ndarray, float]:
    """L2-regularised squared-hinge linear SVM by dual coordinate descent;
    ``y`` is +1 or -1. Classes weigh alike."""
    rng = np.random.default_rng(0)
    gram = (x @ x.T).astype(np.float64) + 1.0  # the bias is one more feature, always 1
    cost = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum())))
    diag = 1 / (2 * cost)
    alpha, margin = np.zeros(len(x)), np.zeros(len(x))
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            g = y[i] * margin[i] - 1 + diag[i] * alpha[i]
            new = max(0.0, alpha[i] - g / (gram[i, i] + diag[i]))
            if new != alpha[i]:
                margin += ((new - alpha[i]) * y[i]) * gram[i]
                alpha[i] = new
    return x.T @ (alpha * y), float((alpha * y).sum())


def grouped(means: np.ndarray, size: int = FAMILY_SIZE) -> list[int]:
    """A group number per row of class means: centres are picked farthest from
    each other, then the closest pairs of class and centre first, ``size`` classes
    a centre at most."""
    n = len(means)
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    centres = [0]
    while len(centres) < -(-n // size):
        centres.append(int((unit @ unit[centres].T).max(axis=1).argmin()))
    like = unit @ unit[centres].T
    out, room = [-1] * n, [size] * len(centres)
    for flat in np.argsort(-like, axis=None, kind="stable"):
        k, c = divmod(int(flat), len(centres))
        if out[k] < 0 and room[c]:
            out[k], room[c] = c, room[c] - 1
    return out


class Model:
    """Families, languages and one weight column per pair of either."""

    def __init__(self, languages: list[str], counts: np.ndarray, label: np.ndarray) -> None:
        family = {code: name for name, codes in FAMILIES.items() for code in codes}
        self.languages = languages
        self.of = [family.get(x.split("-")[0].lower(), "") for x in languages]
        if not len(counts):
            counts = np.zeros((1, counts.shape[1]), np.float32)  # no rows: no pairs are trained either
        freq = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        scale = 1 / np.sqrt(freq.mean(axis=0) + 1e-5)
        x = (freq * scale).astype(np.float32)
        x_norm = float(np.sqrt((x * x).sum(axis=1).mean())) or 1.0
        x /= x_norm
        if unlisted := [k for k, f in enumerate(self.of) if not f]:
            means = np.array([x[label == k].mean(axis=0) for k in unlisted])
            groups = grouped(means)
            for k, g in zip(unlisted, groups):
                self.of[k] = f"other-{g}" if max(groups) else "other"
        self.families = sorted(set(self.of))
        fam = np.array([self.families.index(f) for f in self.of])
        self.pairs: list[tuple[str, int, int]] = []
        columns, self.bias = [], []
        for kind, member in (("family", fam[label] if len(label) else label), ("language", label)):
            names = range(len(self.families) if kind == "family" else len(languages))
            for a, b in combinations(names, 2):
                if kind == "language" and fam[a] != fam[b]:
                    continue
                rows = (member == a) | (member == b)
                w, bias = train_svm(x[rows], np.where(member[rows] == a, 1.0, -1.0))
                self.pairs.append((kind, a, b))
                columns.append(w * scale / x_norm)
                self.bias.append(bias)
        size = counts.shape[1]
        self.weights = np.zeros((size + 1, len(columns)), np.float32)
        if columns:
            self.weights[:size] = np.array(columns).T
        self.fam = fam

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language index and confidence of each row of margins."""
        n = len(margins)

        def vote(kind: str, size: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            votes, margin, sure = np.zeros((n, size)), np.zeros((n, size)), np.ones((n, size))
            for k, (what, a, b) in enumerate(self.pairs):
                if what != kind:
                    continue
                m = margins[:, k]
                p = 1 / (1 + np.exp(-np.clip(4 * m, -50, 50)))
                votes[:, a] += m >= 0
                votes[:, b] += m < 0
                margin[:, a] += m
                margin[:, b] -= m
                sure[:, a] = np.minimum(sure[:, a], p)
                sure[:, b] = np.minimum(sure[:, b], 1 - p)
            rank = np.where(allowed, votes * 1e6 + margin, -np.inf)
            best = rank.argmax(axis=1)
            return best, sure[np.arange(n), best]

        family, p_family = vote("family", len(self.families), np.ones((n, len(self.families)), bool))
        allowed = self.fam[None, :] == family[:, None]
        language, p_language = vote("language", len(self.languages), allowed)
        return language, np.clip(p_family * p_language, 0, 1)


def _count_sample(sample: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Gram counts of the (bounded) sample, by its own tasks; the driver gets
    one sparse row per sampled document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[int, np.ndarray] = {}
            for part, owner, starts in pieces(_lower(batch.column(2)), _CODES, _SPACE, GRAMS):
                for s in range(0, len(starts), 64):
                    few = starts[s:s + 64]
                    end = starts[s + 64] if s + 64 < len(starts) else len(part)
                    for who, row in zip(owner[s:s + 64], gram_counts(part[few[0]:end], few - few[0], GRAMS, BITS)):
                        total[who] = total[who] + row if who in total else row
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = [np.flatnonzero(row) for row in total.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k in total], pa.int64()), pa.array([labels[k] for k in total], pa.string()),
                 pa.array([i.astype("<i4").tobytes() for i in at], pa.binary()),
                 pa.array([row[i].astype("<f4").tobytes() for row, i in zip(total.values(), at)], pa.binary())],
                names=["id", "lang", "at", "n"])

    # one row per id and language, so that repeated rows do not lengthen the sample
    rows = [r.row for r in sample.mapInArrow(run, "id long, lang string, at binary, n binary")
            .groupBy("id", "lang").agg(F.min(F.struct("lang", "at", "n")).alias("row")).collect()]
    rows.sort(key=lambda r: (r.lang, r.at, r.n))
    languages = sorted({r.lang for r in rows})
    counts = np.zeros((len(rows), 1 << BITS), np.float32)
    for k, r in enumerate(rows):
        counts[k, np.frombuffer(r.at, "<i4")] = np.frombuffer(r.n, "<f4")
    return languages, counts, np.array([languages.index(r.lang) for r in rows], int)


def train(docs: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on up to ``per_language`` documents of each language (and ``MAX_ROWS``
    in all) among the rows ``usable`` says."""
    pool = docs.where(usable & F.col(lang).isNotNull() & (F.col(lang) != UNKNOWN) & F.col(text).rlike(_LETTER))
    ids = pool.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"))
    common = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    names = [r["lang"] for r in common]
    per_language = max(1, min(per_language, MAX_ROWS // max(1, len(names))))
    pool, ids = (df.where(F.col(c).isin(names)) for df, c in ((pool, lang), (ids, "lang")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    drawn = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("id")
    sample = pool.join(F.broadcast(drawn.distinct()), F.col(doc_id) == F.col("id"), "left_semi")
    return Model(*_count_sample(sample.select(F.col(doc_id).cast("long").alias("id"), F.col(lang).alias("lang"),
                                              F.col(text).alias("text"))))


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``."""
    fields = [f for c in keep for f in docs.schema.fields if f.name == c]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages**2 columns of 2**BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        bias = np.array(m.bias)
        for batch in (whole.slice(s, 1000) for whole in batches for s in range(0, whole.num_rows, 1000)):
            column = batch.column(len(keep))
            column = column.fill_null("") if column.null_count else column
            sums, count = np.zeros((len(column), m.weights.shape[1])), np.zeros(len(column))
            for part, owner, starts in pieces(_lower(column), _CODES, _SPACE, GRAMS):
                s, c = gram_sums(part, starts, GRAMS, BITS, m.weights)
                np.add.at(sums, owner, s)
                np.add.at(count, owner, c)
            margins = sums / np.maximum(count, 1)[:, None] + bias
            lettered = pc.match_substring_regex(column, _LETTER).to_numpy(zero_copy_only=False)
            if m.languages:
                best, score = m.decide(margins)
                names = np.array(m.languages, object)[best]
            else:
                names, score = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
            names = np.where(lettered, names, UNKNOWN)
            score = np.where(lettered, score, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(names, pa.string()),
                                              pa.array(score.astype(float))], names=[*keep, "lang_pred", "score"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(
        run, StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


__all__ = ["Model", "train", "predict", "train_svm", "FAMILIES", "PER_LANGUAGE", "UNKNOWN"]
