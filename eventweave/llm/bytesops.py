"""Vectorised text helpers over Arrow string columns, used inside Spark tasks.

Every helper works on the concatenated UTF-8 bytes of a slice of rows
(``data``) and the row borders (``offsets``), so the cost per byte is a few
numpy passes and memory is bounded by the slice, not by the task's partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: fixed values: the whitespace bytes of [\x20\x09-\x0D]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes that end a word for the "alphanumeric run" word rule (ASCII only; bytes over 0x7F belong to words)
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
NOT_ALNUM[128:] = False


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; a null reads as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    binary = pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type)
    if arr.null_count:
        arr = arr.fill_null(b"" if binary else "")
    arr = arr.cast(pa.large_binary() if binary else pa.large_string())
    _, off, dat = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    if len(arr) == 0 or dat is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(arr) + 1, dtype=np.int64)
    data = np.frombuffer(dat, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on between tasks, and
    what it keeps adds to the next task's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # in the GNU C library
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of ``column``
    (a single longer row forms a slice of its own)."""
    if batch.num_rows == 0:
        return
    _, off = buffers(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word borders: (start, end, first word of each row + total), rows never share a word."""
    n = len(data)
    if n == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = ~breaks[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    border = offsets[(offsets > 0) & (offsets < n)]
    start[border] = inside[border]
    end[border - 1] = inside[border - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offsets)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i+1]]`` for each row i (0 for empty rows).

    Summed per row (never a difference of long prefix sums), so equal rows give equal sums."""
    out = np.zeros(len(first) - 1, dtype=values.dtype)
    full = first[1:] > first[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out


#: odd multipliers of the word hashes; words have a second hash where 64 bits are too few to tell them apart
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for slices of the usual size."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 2 * SLICE_BYTES:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes, equal wherever the word stands."""
    if len(start) == 0:
        return np.empty(0, dtype=np.uint64)
    base = _BASES[which]
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(base, len(data)), out=prefix[1:])
    value = (prefix[end] - prefix[start]) * _powers(pow(base, -1, 1 << 64), len(data))[start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(word: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words and their first index per row.

    A row of 1 to k-1 words has one shingle, its whole sequence."""
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    begin = np.zeros(len(first), dtype=np.int64)
    np.cumsum(n, out=begin[1:])
    total = int(begin[-1])
    if total == 0:
        return np.empty(0, dtype=np.uint64), begin
    row = np.repeat(np.arange(len(n)), n)
    at = first[:-1][row] + (np.arange(total) - begin[:-1][row])
    size = np.minimum(count, k)[row]
    acc = np.zeros(total, dtype=np.uint64)
    padded = np.concatenate([word, np.zeros(k, dtype=np.uint64)])
    for j in range(k):
        term = padded[at + j] * np.uint64(pow(_BASES[0], j + 1, 1 << 64))
        acc += np.where(size > j, term, np.uint64(0))
    return mix(acc + size.astype(np.uint64)), begin
