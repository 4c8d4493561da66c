"""Hashed byte n-gram features of Arrow text batches, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from daylake.llm.common import slices, utf8

PIECE = 1 << 20  # bytes looked at together; bounds memory, not the texts
_PRIME, _MIX = np.uint32(16777619), np.uint32(2654435761)


def gram_hash(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A ``bits``-bit hash of every n-gram of ``codes`` (uint8)."""
    wide = codes.astype(np.uint32)
    acc = wide[:len(wide) - n + 1] + np.uint32(n)
    for j in range(1, n):
        acc *= _PRIME
        acc += wide[j:len(wide) - n + 1 + j]
    acc *= _MIX
    acc ^= acc >> np.uint32(15)
    acc *= _MIX
    return (acc >> np.uint32(32 - bits)).astype(np.int32)


def pieces(column: pa.Array, codes: np.ndarray, squeeze: int | None, grams: tuple[int, ...],
           pad: bool = True, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts, of about ``size`` bytes, as code arrays: ``(codes, owner, starts)``.

    ``codes`` maps each byte to its code; runs of the code ``squeeze`` become
    one. With ``pad`` every text gets a space before and after it.
    """
    column = column.fill_null("") if column.null_count else column
    if pad:
        column = pc.binary_join_element_wise(pa.scalar(" ", column.type), column, pa.scalar(" ", column.type),
                                             pa.scalar("", column.type))
    raw, offsets = utf8(column)
    data = codes[raw]
    if squeeze is not None and len(data):
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != squeeze) | (data[:-1] != squeeze)
        inner = offsets[(offsets < len(data))]
        keep[inner] = True
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        data = data[keep]
    for lo, hi, owner, starts in slices(offsets, size, max(grams) - 1):
        yield data[lo:hi], owner, starts


def gram_sums(part: np.ndarray, starts: np.ndarray, grams: tuple[int, ...], bits: int,
              weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per piece: the summed weight rows of its n-grams, and how many it has.

    ``weights`` has ``2**bits + 1`` rows, the last all zero: grams that reach
    into the next piece point there. Grams of a shorter length that an
    overlap repeats are counted again; a cut comes once in 2**20 bytes.
    """
    ends = np.concatenate((starts[1:], [len(part)]))
    sums = np.zeros((len(starts), weights.shape[1]))
    count = np.zeros(len(starts))
    for n in grams:
        if len(part) < n:
            continue
        idx = gram_hash(part, n, bits)
        if n > 1 and len(starts) > 1:
            over = (ends[:-1, None] - np.arange(1, n)).ravel()
            over = over[(over >= 0) & (over < len(idx))]
            idx[over] = 1 << bits
        live = starts < len(idx)
        sums[live] += np.add.reduceat(weights[idx], starts[live], axis=0)
        count += np.maximum(ends - starts - n + 1, 0)
    return sums, count


def gram_counts(part: np.ndarray, starts: np.ndarray, grams: tuple[int, ...], bits: int) -> np.ndarray:
    """Per piece: how often each hash value occurs (pieces x 2**bits)."""
    size = 1 << bits
    ends = np.concatenate((starts[1:], [len(part)]))
    row = np.repeat(np.arange(len(starts)), ends - starts)
    total = np.zeros(len(starts) * (size + 1), np.float32)
    for n in grams:
        if len(part) < n:
            continue
        idx = gram_hash(part, n, bits).astype(np.int64)
        if n > 1 and len(starts) > 1:
            over = (ends[:-1, None] - np.arange(1, n)).ravel()
            over = over[(over >= 0) & (over < len(idx))]
            idx[over] = size
        idx += row[:len(idx)] * (size + 1)
        total += np.bincount(idx, minlength=len(total)).astype(np.float32)
    return total.reshape(len(starts), size + 1)[:, :size]


__all__ = ["gram_hash", "pieces", "gram_sums", "gram_counts", "PIECE"]
