"""Words of a text column as flat numpy arrays.

A word is a maximal run of bytes that are not ASCII white space (0x20,
0x09-0x0D). ``slabs`` cuts an Arrow batch into row ranges of bounded bytes (a
longer text is a slab of its own, never cut), ``Words`` lays one slab out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from daylake.llm.common import utf8

SLAB_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def slabs(column: pa.Array, size: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``(from, to)`` of about ``size`` bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, to
        at = to


class Words:
    """``raw``: the texts laid end to end, each followed by a line feed, with
    text ``k`` at ``texts[k]:texts[k + 1]``. Word ``w`` is
    ``raw[starts[w]:ends[w]]``; text ``k`` has words ``first[k]:first[k + 1]``.
    A NULL text has no words."""

    def __init__(self, column: pa.Array) -> None:
        large = pa.large_string()
        closed = pc.binary_join_element_wise(
            column.cast(large).fill_null(""), pa.scalar("", large), pa.scalar("\n", large))
        self.raw, self.texts = utf8(closed)
        self.is_word = ~SPACE[self.raw]
        step = np.diff(self.is_word.view(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.starts, self.texts)
        self.counts = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)

    @cached_property
    def ids(self) -> np.ndarray:
        """A number per word, equal for equal words of the slab."""
        ends = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=ends[1:])
        return numbered(self.raw[self.is_word], ends)

    @cached_property
    def points_before(self) -> np.ndarray:
        """Code points of words before each byte."""
        out = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum(self.is_word & ((self.raw & 0xC0) != 0x80), out=out[1:])
        return out

    def word(self, w: int) -> bytes:
        return self.raw[self.starts[w]:self.ends[w]].tobytes()


def numbered(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number per piece ``data[ends[k]:ends[k + 1]]``, equal for equal pieces."""
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return pieces.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


__all__ = ["Words", "numbered", "slabs", "SLAB_BYTES", "SPACE"]
