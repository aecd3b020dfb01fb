"""Word boundaries and word hashes of Arrow text columns, on their UTF-8 bytes.

Words are runs of bytes other than space and 0x09-0x0D. Work goes over slices of a few megabytes of whole
documents, so memory follows the slice (or the longest document), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: Bytes hashed at a time.
HASH_BYTES = 1 << 18

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-known 64-bit finaliser: every input bit changes about half of the output."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: A fixed random value for each byte; powers of an odd base and of its inverse modulo 2**64.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWER: list[np.ndarray] = [_powers(_BASE, HASH_BYTES), _powers(pow(_BASE, -1, 1 << 64), HASH_BYTES)]


def _power(n: int) -> list[np.ndarray]:
    if len(_POWER[0]) < n:  # one word longer than any before
        _POWER[:] = [_powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)]
    return _POWER


@dataclass
class Slice:
    """Documents first..first+n-1 of a column: their bytes and the offsets of each."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the number of the first word of each document (n + 1 entries)."""
        inside = ~SPACE[self.data]
        cut = np.zeros(len(self.data) + 1, dtype=bool)
        cut[self.offsets] = True
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | cut[1:-1]
        end[:-1] &= ~inside[1:] | cut[1:-1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """A string column by slices of about `size` bytes; null counts as empty."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield Slice(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, with A-Z lower-cased if asked."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")))
        lo, hi = starts[i], ends[j - 1]
        power, inverse = _power(hi - lo)
        part = data[lo:hi]
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_BYTE[LOWER[part] if lower else part] * power[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * _ODD
        i = j
    return mixed(out)


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows inside documents and the number of the first window of each document.

    A document of 1..k-1 words has one window, all its words; one without words has none.
    """
    n = np.diff(first)
    windows = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(windows)])
    at = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], windows)
    length = np.repeat(np.minimum(n, k), windows)
    padded = np.concatenate([words, np.zeros(k, dtype=np.uint64)])
    out = length.astype(np.uint64) * _ODD
    for j in range(k):
        factor = np.uint64((_BASE * (2 * j + 3)) & _MASK | 1)
        term = padded[at + j] * factor
        out += term if not len(n) or n.min(initial=k) >= k else np.where(j < length, term, np.uint64(0))
    return mixed(out), starts
