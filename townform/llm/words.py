"""Words of whole Arrow batches as numpy arrays: bounds and 64-bit fingerprints, no loop over rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: An odd multiplier; its inverse modulo 2**64 turns sums from the start into sums of a slice.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20240501))
BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true inside the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Everything but blanks: [^\x20\x09-\x0D]
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Letters, digits and all beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a fingerprint so that every bit depends on all of it."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse."""
    out = []
    for base in (BASE, INVERSE):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << 12
    while size < n:
        size *= 2
    return powers(size)


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Weighted sums of byte codes before each position."""
    up, _ = powers_for(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_CODES[buf] * up[:len(buf)], out=out[1:])
    return out


def slice_prints(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of the byte slices [start, end), equal for equal bytes wherever they stand."""
    _, down = powers_for(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of several texts in one buffer; ``row`` names the text, ``first`` its first word."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray
    prints: np.ndarray


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string or binary column into runs of rows: first row, bytes, offsets. Null is empty.

    A run holds ``most`` bytes at the most, or one text if that alone is longer.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = min(n, max(end, begin + 1))
        yield begin, data[offsets[begin]:offsets[end]], offsets[begin:end + 1] - offsets[begin]
        begin = end


def split_words(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool = True,
                prints: bool = True) -> Words:
    """Words are maximal runs of bytes whose flag in ``inside`` is set, within one text."""
    if lower:
        buf = LOWER[buf]
    flag = inside[buf]
    n = len(buf)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(buf, offsets, none, none, none, np.zeros(len(offsets), np.int64), none.astype(np.uint64))
    fresh = np.zeros(n + 1, bool)
    fresh[offsets[:-1]] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = flag[:-1]
    starts = np.flatnonzero(flag & (~before | fresh[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = flag[1:]
    last = fresh[1:].copy()
    last[-1] = True
    ends = np.flatnonzero(flag & (~after | last)) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(buf, offsets, starts, ends, row, first,
                 slice_prints(prefix_sums(buf), starts, ends) if prints else np.zeros(0, np.uint64))


def window_prints(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of ``size`` consecutive words of a text, and the first word of each.

    A text with fewer words, but not none, is one window.
    """
    counts = np.diff(words.first)
    n = len(words.prints)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = powers_for(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words.prints * up[:n], out=sums[1:])
    left = words.first[1:][words.row] - np.arange(n)  # words from here to the end of the text
    short = (counts < size)[words.row]
    at_first = np.arange(n) == words.first[:-1][words.row]
    begin = np.flatnonzero((left >= size) | (short & at_first))
    end = begin + np.minimum(size, left[begin])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin
