"""Arrow string batches as flat UTF-8 byte arrays, so that numpy works on whole batches.

Hashes are polynomials over bytes or words modulo 2**64 taken from prefix sums, hence
one vector operation for any number of words. The multiplier is odd and therefore has
an inverse, which turns a slice of the prefix sum into the hash of the slice alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BATCH_BYTES = 2 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: The white space of ``bytes.split``.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers, so that any of them can serve as a bucket."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def lower_latin(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and the two-byte letters of Latin-1; byte positions stay the same."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    out[second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return out


def powers(n: int, base: np.uint64) -> np.ndarray:
    """``base`` to the powers 0 .. n - 1, modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class SliceHashes:
    """Hashes of slices of one array of integers, independent of where a slice lies."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._prefix = np.zeros(n + 1, np.uint64)
        weighted = (values.astype(np.uint64) + np.uint64(1)) * powers(n, _MULTIPLIER)
        np.cumsum(weighted, dtype=np.uint64, out=self._prefix[1:])
        self._inverse = powers(n + 1, _INVERSE)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of ``values[start:end]``; multiply by an odd number to mix further."""
        return (self._prefix[ends] - self._prefix[starts]) * self._inverse[starts]


@dataclass
class TextBatch:
    """Some whole texts in one byte array; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def tokens(self, inside: np.ndarray) -> Tokens:
        """Runs of bytes for which the 256-entry table ``inside`` holds; none spans two texts."""
        mask = np.zeros(len(self.data) + 1, bool)
        mask[:-1] = inside[self.data]
        first = mask.copy()
        first[1:] &= ~mask[:-1]
        last = mask.copy()
        last[:-1] &= ~mask[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(self.data))]
        first[edges] |= mask[edges]
        last[edges - 1] |= mask[edges - 1]
        starts = np.flatnonzero(first)
        ends = np.flatnonzero(last) + 1
        return Tokens(starts, ends, np.searchsorted(starts, self.offsets))


@dataclass
class Tokens:
    """Token spans; those of text i are ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self) -> np.ndarray:
        """The text that each token belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_batch(texts: pa.Array) -> TextBatch:
    """The texts of one Arrow string array; a null counts as an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return TextBatch(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return TextBatch(flat[bounds[0] : bounds[-1]], bounds - bounds[0])


def pieces(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into parts of about ``limit`` bytes of text; a longer text is a
    part of its own. Memory per step then follows the longest text, not the batch."""
    sizes = np.diff(text_batch(batch.column(batch.schema.names.index(column))).offsets)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:], strict=False):
        if high > low:
            yield batch.slice(low, high - low)


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte position, ``len(data) + 1`` entries."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
