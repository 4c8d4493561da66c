"""Token-ID output (8): one wavelet matrix per shard.

File format. The output folder is a Parquet table with one row per shard, a few
shards a compressed file (``SHARDS_A_FILE``: a reader holds the shards of a file
at once), written through Spark's commit protocol. A row has ``part`` and ``seq`` (shard order:
ascending document id), ``n_docs``, ``n_ids``, and ``payload``:

    magic "WMX1" | u32 planes | u64 ids | u64 docs
    doc table: per document i64 id, u8 id-is-null, i64 ids in it
    per plane, most significant bit first: u64 zeros,
        u32 ones before every 512-bit block, the bits (little-endian in bytes)

Plane k holds bit k of every id in the order left by the planes above (a
stable partition, zeros first). ``access``, ``rank``, ``count`` and ``locate``
(select) walk the planes with the block counts; ``decode`` undoes the
partitions for the whole shard.

Shards: documents are range-partitioned and sorted by id, and a task closes a
shard when it holds ``shard_ids`` ids, so memory is bounded by the shard (or
by one longer document). NULL text is empty; each document ends in id 0;
NULL ids sort first; rows that share an id follow each other, ordered by a
hash of the text, and are separate documents.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daylake.llm.words import slabs

MAGIC, BLOCK = b"WMX1", 512
SHARD_IDS = 2_000_000
SHARDS_A_FILE = 4
END_ID = 0
CACHED, CACHED_CHARS = 1_000_000, 48
SHARD_SCHEMA = "part int, seq int, n_docs long, n_ids long, payload binary"
# A space between two characters that are not white space always starts a
# new word of a byte-level tokenizer, so texts may be cut there.
SAFE = re.compile(r"(?<=\S) (?=\S)")
# Texts where a space may not be a safe cut: one that meets other white space.
ODD = ("  | [\\n\\t]|[\\n\\t] |[\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
       "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")


# Words made of these parts alone split the same way under the byte-level
# pattern (runs of letters, runs of marks, a line break before a word), so
# their parts go to the tokenizer's model one by one; all other words take
# the whole path. No apostrophe (contractions) and no "<" (special tokens).
SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([-.,!%&*#$|;:?()/+=]*)").fullmatch
PART = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[-.,!%&*#$|;:?()/+=]+|\n(?=\\S)")


class Encoder:
    """``tokenizers`` encoding of whole texts, with the ids of words seen
    before kept (up to ``CACHED`` words, then forgotten)."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.wide = "I" if self.tokenizer.get_vocab_size(True) > 1 << 16 else "H"
        self.seen: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        pre = self.tokenizer.pre_tokenizer
        self.by_parts = (isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space
                         and pre.use_regex and self.tokenizer.normalizer is None)
        # the alphabet that the byte-level models use for the 256 bytes
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: chr(b) for b in shown}
        self.alphabet |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.alphabet[0] = self.alphabet[0x20]      # NUL stands for the space of a word (see _model_ids)

    def _fill(self, texts: list[str]) -> list[bytes]:
        ids = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.wide, x.ids).tobytes() for x in ids]

    def _model_ids(self, part: str) -> bytes:
        """Ids of a part on its own; NUL stands for the space before a word."""
        if not part.isascii():
            part = part.encode().decode("latin-1")
        return array(self.wide, [t.id for t in self.tokenize(part.translate(self.alphabet))]).tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = self._model_ids(part)
        return ids

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word with a space before it (and of the bare words of
        those that end in marks)."""
        out, rest, part = {}, [], self._part
        bare_ids, simple, wide, tokenize, space = self.seen.get, SIMPLE, self.wide, self.tokenize, self.alphabet[0]
        for word in words:
            if not self.by_parts or len(word) > CACHED_CHARS:
                rest.append(word)
            elif found := simple(word):
                bare, marks = found.groups()
                ids = out.get(bare) or bare_ids(bare)
                if ids is None:
                    # ASCII letters are themselves in the model's alphabet
                    ids = out[bare] = (array(wide, [t.id for t in tokenize(space + bare)]).tobytes()
                                       if bare.isascii() else self._model_ids("\0" + bare))
                out[word] = ids + part(marks) if marks else ids
            else:
                parts = PART.findall(word)
                if parts and sum(map(len, parts)) == len(word):
                    parts[0] = "\0" + parts[0]
                    out[word] = b"".join(map(part, parts))
                else:
                    rest.append(word)
        out.update(zip(rest, self._fill([" " + w for w in rest])))
        return out

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts that may be cut at every space. Words are numbered by
        Arrow, so Python sees each distinct word of the slab once; the ids are
        then gathered by number."""
        lists = pc.split_pattern(texts, " ")
        flat, bounds = lists.flatten(), lists.offsets.to_numpy()
        bounds = bounds - bounds[0]
        strings = lambda column: column.to_numpy(zero_copy_only=False).tolist()
        heads = self._fill(strings(flat.take(pa.array(bounds[:-1]))))
        inner = np.ones(len(flat), bool)
        inner[bounds[:-1]] = False
        coded = flat.filter(pa.array(inner)).dictionary_encode()
        words, codes = strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        got = list(map(self.seen.get, words))
        if None in got:
            fresh = self._words([w for w, ids in zip(words, got) if ids is None])
            got = [fresh[w] if ids is None else ids for w, ids in zip(words, got)]
            self.seen.update((w, ids) for w, ids in fresh.items() if len(w) <= CACHED_CHARS)
        kind = np.dtype(np.uint32 if self.wide == "I" else np.uint16)
        pool = np.frombuffer(b"".join(got), kind)
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // kind.itemsize
        begins = np.cumsum(sizes) - sizes
        long = sizes[codes]
        ends = np.cumsum(long)
        ids = pool[np.repeat(begins[codes] - ends + long, long) + np.arange(ends[-1] if len(ends) else 0)]
        # words of text k: from the k-th bound, less the heads before it
        cut = np.concatenate(([0], ends))[bounds - np.arange(len(bounds))]
        return [np.concatenate((np.frombuffer(head, kind), ids[a:b])) for head, a, b in zip(heads, cut, cut[1:])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids per text."""
        if len(self.seen) > CACHED:
            self.seen.clear()
        if len(self.parts) > CACHED:
            self.parts.clear()
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._plain(texts)
        out = np.empty(len(texts), object)
        for k, ids in zip(np.flatnonzero(~odd), self._plain(texts.filter(pa.array(~odd)))):
            out[k] = ids
        kind = np.uint32 if self.wide == "I" else np.uint16
        for k in np.flatnonzero(odd):
            words = SAFE.split(texts[int(k)].as_py())
            head = self._fill(words[:1])[0]
            del words[0]
            known = {w: ids for w in set(words) if (ids := self.seen.get(w)) is not None}
            fresh = self._words([w for w in dict.fromkeys(words) if w not in known])
            self.seen.update((w, ids) for w, ids in fresh.items() if len(w) <= CACHED_CHARS)
            known |= fresh
            out[k] = np.frombuffer(head + b"".join(map(known.__getitem__, words)), kind)
        return list(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, planes: int) -> bytes:
    """A shard's payload."""
    null = np.array([d is None for d in doc_ids], np.uint8)
    named = np.array([0 if d is None else d for d in doc_ids], np.int64)
    out = [MAGIC, struct.pack("<IQQ", planes, len(ids), len(doc_ids)), named.tobytes(), null.tobytes(),
           np.asarray(lengths, np.int64).tobytes()]
    for plane in range(planes - 1, -1, -1):
        bit = (ids & ids.dtype.type(1 << plane)) != 0
        bits = np.packbits(bit, bitorder="little")
        padded = np.zeros(-(-len(ids) // BLOCK) * BLOCK // 8, np.uint8)
        padded[:len(bits)] = bits
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        before = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
        low = np.compress(~bit, ids)
        out += [struct.pack("<Q", len(low)), before.tobytes(), padded.tobytes()]
        ids = np.concatenate((low, np.compress(bit, ids)))
    return b"".join(out)


class WaveletMatrix:
    """Queries on one shard's payload, without decoding it."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a shard of this format")
        self.planes, self.n, docs = struct.unpack_from("<IQQ", payload, 4)
        at = 24
        named = np.frombuffer(payload, "<i8", docs, at)
        null = np.frombuffer(payload, np.uint8, docs, at := at + 8 * docs)
        self.lengths = np.frombuffer(payload, "<i8", docs, at := at + docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(named, null)]
        at += 8 * docs
        blocks = -(-self.n // BLOCK)
        self.zeros, self.before, self.bits = [], [], []
        for _ in range(self.planes):
            self.zeros.append(struct.unpack_from("<Q", payload, at)[0])
            self.before.append(np.frombuffer(payload, "<u4", blocks, at := at + 8))
            self.bits.append(np.frombuffer(payload, np.uint8, blocks * BLOCK // 8, at := at + 4 * blocks))
            at += blocks * BLOCK // 8

    def _ones(self, k: int, i: int) -> int:
        """Ones of plane ``k`` before position ``i``."""
        block = i // BLOCK
        if block == len(self.before[k]):
            return self.n - self.zeros[k]
        lo, byte = block * BLOCK // 8, i // 8
        n = int(self.before[k][block]) + int(np.bitwise_count(self.bits[k][lo:byte]).sum())
        return n + (int(self.bits[k][byte]) & ((1 << i % 8) - 1)).bit_count()

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k in range(self.planes):
            bit = int(self.bits[k][i // 8]) >> i % 8 & 1
            ones = self._ones(k, i)
            i = self.zeros[k] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token < 0 or token >> self.planes:
            return 0, 0
        for k in range(self.planes):
            a, b = self._ones(k, lo), self._ones(k, hi)
            if token >> (self.planes - 1 - k) & 1:
                lo, hi = self.zeros[k] + a, self.zeros[k] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``token`` in positions ``lo`` to ``hi`` (excluded)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, k: int, nth: int, bit: int) -> int:
        """Position of the ``nth`` (from 0) ``bit`` in plane ``k``."""
        before = self.before[k]
        seen = (lambda b: int(before[b])) if bit else (lambda b: b * BLOCK - int(before[b]))
        block = bisect_right(range(len(before)), nth, key=seen) - 1
        span = self.bits[k][block * BLOCK // 8:(block + 1) * BLOCK // 8]
        flat = np.unpackbits(span, bitorder="little")
        return block * BLOCK + int(np.flatnonzero(flat == bit)[nth - seen(block)])

    def locate(self, token: int, nth: int = 0) -> int:
        """Position of the ``nth`` occurrence (from 0) of ``token``."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= nth < hi - lo:
            raise IndexError(nth)
        i = lo + nth
        for k in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - k) & 1
            i = self._select(k, i - self.zeros[k] if bit else i, bit)
        return i

    def locate_all(self, token: int, step: int = 1 << 14) -> Iterator[np.ndarray]:
        """Positions of all occurrences of ``token``, ascending, ``step`` at a
        time: ``locate`` for many at once."""
        lo, hi = self._range(token, 0, self.n)
        starts = np.arange(len(self.before[0]), dtype=np.int64) * BLOCK if self.planes else None
        for s in range(lo, hi, step):
            at = np.arange(s, min(s + step, hi))
            for k in range(self.planes - 1, -1, -1):
                bit = token >> (self.planes - 1 - k) & 1
                nth = at - self.zeros[k] if bit else at
                seen = self.before[k].astype(np.int64) if bit else starts - self.before[k]
                block = np.searchsorted(seen, nth, side="right") - 1
                flat = np.unpackbits(self.bits[k].reshape(-1, BLOCK // 8)[block], axis=1, bitorder="little")
                rank = np.cumsum(flat == bit, axis=1, dtype=np.int16)
                at = block * BLOCK + (rank > (nth - seen[block])[:, None]).argmax(axis=1)
            yield at

    def decode(self) -> np.ndarray:
        """All ids in order."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for k in range(self.planes - 1, -1, -1):
            bit = np.unpackbits(self.bits[k], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(ids)
            ids[self.zeros[k]:] |= kind(1 << (self.planes - 1 - k))
            above[np.flatnonzero(bit)] = ids[self.zeros[k]:]
            above[np.flatnonzero(np.logical_not(bit, out=bit))] = ids[:self.zeros[k]]
            ids = above
        return ids


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 shard_ids: int = SHARD_IDS, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the shards to ``path``."""
    sorted_docs = (docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
                   .withColumn("tie", F.xxhash64("text"))
                   .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer)
        planes = max(1, (enc.tokenizer.get_vocab_size(True) - 1).bit_length(), end_id.bit_length())
        end = np.array([end_id], np.uint32 if enc.wide == "I" else np.uint16)
        named: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            payload = pack(np.concatenate(parts), named, np.array(lengths), planes)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(named)], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "seq", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for a, b in slabs(batch.column(1)):
                few = batch.slice(a, b - a)
                for name, ids in zip(few.column(0).to_pylist(), enc.encode(few.column(1))):
                    if named and held + len(ids) >= shard_ids:
                        yield shard()
                        named, lengths, parts, held, seq = [], [], [], 0, seq + 1
                    named.append(name)
                    lengths.append(len(ids) + 1)
                    parts += [ids, end]
                    held += len(ids) + 1
        if named:
            yield shard()

    (sorted_docs.select("id", "text").mapInArrow(run, SHARD_SCHEMA)
     .write.option("maxRecordsPerFile", SHARDS_A_FILE).option("compression", "zstd").parquet(path))


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, seq, start)``: ids in all shards before each shard."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "n_ids")
    # two steps: totals of the parts (as many as tasks wrote), then inside a part
    parts = (shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .withColumn("base", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "base"))
    inside = Window.partitionBy("part").orderBy("seq")
    return (shards.withColumn("before", F.sum("n_ids").over(inside) - F.col("n_ids"))
            .join(parts, "part").select("part", "seq", (F.col("base") + F.col("before")).alias("start")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` (of its ids as
    little-endian unsigned 32-bit integers)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                matrix = WaveletMatrix(batch.column(2)[k].as_py())
                ids = matrix.decode().astype("<u4", copy=False)
                ends = np.cumsum(matrix.lengths)
                begins = ends - matrix.lengths
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(0)[k].as_py(), np.int32)),
                     pa.array(np.full(n, batch.column(1)[k].as_py(), np.int32)),
                     pa.array(matrix.doc_ids, pa.int64()), pa.array(begins), pa.array(matrix.lengths),
                     pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "begin", "n_tokens", "ids_crc32"])

    decoded = shards.mapInArrow(
        run, "part int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return decoded.join(shard_starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Occurrences of one id in each shard, by rank on the planes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [WaveletMatrix(p.as_py()).count(token) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                                             names=["part", "seq", "n"])

    return (spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "payload")
            .mapInArrow(run, "part int, seq int, n long"))


def locate_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Global position of every occurrence of one id, by select."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*batch.columns):
                matrix = WaveletMatrix(payload.as_py())
                for at in matrix.locate_all(token):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), part.as_py(), np.int32)),
                         pa.array(np.full(len(at), seq.as_py(), np.int32)), pa.array(at, pa.int64())],
                        names=["part", "seq", "at"])

    found = (spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "payload")
             .mapInArrow(run, "part int, seq int, at long"))
    return found.join(shard_starts(spark, path), ["part", "seq"]).select((F.col("start") + F.col("at")).alias("position"))


__all__ = ["Encoder", "WaveletMatrix", "pack", "write_tokens", "shard_starts", "read_documents",
           "count_token", "locate_token"]
