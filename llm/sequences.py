"""Vectorised words, shingles, window hashes and anchors for batches of texts (numpy, inside tasks).

Hashes are 64-bit polynomial sums over random byte values, so that every
substring hash of a batch comes from one prefix sum. Words are the maximal runs
``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SPLIT = np.zeros(256, dtype=bool)
SPLIT[[9, 10, 11, 12, 13, 32]] = True
POSITION_BITS = np.uint64(28)
POSITION = np.uint64((1 << 28) - 1)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


class WindowHash:
    """Hashes of every run of ``width`` neighbouring values."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(values * powers(BASE, self.n), out=self.sums[1:])

    def of_width(self, width: int) -> np.ndarray:
        """One raw hash per start; starts in the last ``width - 1`` places have none."""
        n = max(0, self.n - width + 1)
        return (self.sums[width : width + n] - self.sums[:n]) * powers(BASE_INVERSE, n)

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = powers(BASE_INVERSE, self.n + 1)
        return (self.sums[end] - self.sums[start]) * inverse[start]


@dataclass
class Words:
    """Words of a batch of documents: hash, byte range, and each document's range of words."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray


def batches(column, limit: int = 1 << 20, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of an Arrow binary column with about ``limit`` bytes and at most ``most`` rows each, one row at least."""
    offsets = np.asarray(byte_offsets(column), dtype=np.int64)
    row, rows = 0, len(column)
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(rows, row + most, max(stop, row + 1))
        yield row, stop
        row = stop


def byte_offsets(column) -> np.ndarray:
    import pyarrow as pa

    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=kind)
    return raw[column.offset : column.offset + len(column) + 1]


def as_bytes(column):
    """A contiguous binary Arrow array, nulls as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    return column


def flat_bytes(column, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of rows ``start .. stop`` end to end, and their bounds from 0."""
    offsets = byte_offsets(column)[start : stop + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def words_of(data: np.ndarray, bounds: np.ndarray, hashed: bool = True) -> Words:
    """Words of flat bytes; a document's edge always ends a word."""
    solid = ~SPLIT[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = bounds[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = solid[edges]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = edges[edges > 0] - 1
    ends[last] = solid[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = mix(WindowHash(BYTE_VALUES[data]).between(start, end)) if hashed else np.zeros(0, np.uint64)
    return Words(hashes, start, end, np.searchsorted(start, bounds))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    n, span = len(values) - width + 1, 1
    if n <= 0:
        return values[:0]
    out = values
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[width - span : width - span + n])


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set in a map of 64-bit words (see ``storage.bit_map``)."""
    place = hashes >> np.uint64(65 - (64 * len(bits)).bit_length())
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


@dataclass
class Anchors:
    """Per anchor: document row, gram hash, place of the gram, first and last window start it serves, class hash.

    Places and starts count from the start of the document. Equal windows have
    the same anchor gram at the same distance, since the choice (least hash, then
    leftmost) looks at the window alone; every window belongs to one anchor.
    """

    row: np.ndarray
    gram: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    content: np.ndarray


def anchors_of(values: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> Anchors:
    """Anchors of all windows of ``window`` values that lie in one document."""
    spread = window - gram + 1
    n = len(values) - window + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return Anchors(none, none, none, none, none, none)
    sums = WindowHash(values)
    grams = mix(sums.of_width(gram))
    places = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams & ~POSITION) | places, spread)
    where = (least & POSITION).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    valid = np.arange(n) + window <= bounds[row + 1]
    new = np.ones(n, dtype=bool)
    new[1:] = (where[1:] != where[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(new & valid)
    stops = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    place = where[starts]
    doc = row[starts]
    content = sums.between(starts, stops + window)
    shape = ((place - starts) * (1 << 20) + (stops - starts)).astype(np.uint64)
    content = mix(content ^ mix(shape + np.uint64(1)))
    base = bounds[doc]
    return Anchors(doc, grams[place].view(np.int64), place - base, starts - base, stops - base, content.view(np.int64))
