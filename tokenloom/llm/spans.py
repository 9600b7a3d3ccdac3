"""Words, shingles and their hashes over whole batches of texts, as numpy arrays of UTF-8 bytes.

Every separator of the word patterns used here is an ASCII byte, so a scan of bytes finds the same words as the pattern
over characters. Batches are cut into slices of about ``SLICE_BYTES`` so that memory follows the slice; a longer text is
a slice of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_table(pattern: bytes) -> np.ndarray:
    """256 flags: the bytes of ``pattern``."""
    table = np.zeros(256, bool)
    table[np.frombuffer(pattern, np.uint8)] = True
    return table


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~byte_table(b" \t\n\x0b\x0c\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became lower case
LETTERS_DIGITS = byte_table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Slice:
    """Rows ``first`` to ``last`` of a batch: their bytes joined, and where each row begins (one more at the end)."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first

    def row_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, place, side="right") - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each row."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]


def slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 14) -> Iterator[Slice]:
    """Cut a string column into slices of at most ``rows`` rows; a null is an empty text."""
    values = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(values):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + rows, len(values))
        yield Slice(first, last, bytes_[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def word_bounds(part: Slice, data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of the table's bytes; runs end with their row."""
    inside = table[data]
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[part.at[part.at < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[part.at[part.at > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix64's finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    return _powers(1 << max(16, int(n).bit_length()))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the span stands."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive word hashes of the whole array; the caller drops those across rows."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix(out * _BASE + words[i : i + n])
    return out


def row_windows(row: np.ndarray, width: int) -> np.ndarray:
    """Places where ``width`` consecutive words belong to one row."""
    if len(row) < width:
        return np.zeros(0, np.int64)
    return np.flatnonzero(row[: len(row) - width + 1] == row[width - 1 :])
