"""Numpy kernels over the UTF-8 bytes of an Arrow text column.

They run inside Spark's Arrow batches. A batch is cut into chunks of whole rows of
about ``CHUNK`` bytes, so memory follows the chunk and the longest single text.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the row offsets into them; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return bytes_, at - at[0]


def chunks(data: np.ndarray, at: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    low, n = 0, len(at) - 1
    while low < n:
        high = min(n, max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1))
        yield low, high, data[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def words(data: np.ndarray, at: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of bytes that aren't separators."""
    inside = ~separator[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = at[(at > 0) & (at < len(data))]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at[1:], starts, side="right")


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK // 4)
        for i, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums from which ``span_hashes`` reads any span's hash."""
    up, _ = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[:-1], out=total[1:])
    return total


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes give equal hashes at any place."""
    _, down = powers(len(total))
    return mix((total[ends] - total[starts]) * down[starts])


PRIME = np.uint64((1 << 31) - 1)
PRIME_CODES = np.random.Generator(np.random.PCG64(61)).integers(1, int(PRIME), 256, dtype=np.uint64)
_prime_base = 1_367_130_551
_prime_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a number and of its inverse modulo ``PRIME``."""
    if len(_prime_powers[0]) < n:
        for i, base in enumerate((_prime_base, pow(_prime_base, -1, int(PRIME)))):
            made = np.ones(1, np.uint64)
            while len(made) < max(n, CHUNK // 4):
                made = np.concatenate([made, made * np.uint64(pow(base, len(made), int(PRIME))) % PRIME])
            _prime_powers[i] = made
    return _prime_powers[0][:n], _prime_powers[1][:n]


def strong_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans from two polynomials, one modulo 2**64 and one modulo a prime.

    Modulo a power of two some texts of two letters (Thue-Morse words and their
    complements) agree for any base; modulo the prime they don't.
    """
    up, down = prime_powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(PRIME_CODES[data] * up[:-1] % PRIME, out=total[1:])
    other = (total[ends] - total[starts]) % PRIME * down[starts] % PRIME
    return mix(span_hashes(prefix_hashes(data), starts, ends) ^ mix(other + np.uint64(1)))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] of them, then those of starts[1], and so on."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def tidy(run):
    """``run``, a function of Arrow batches, giving freed memory back when a task ends: Python
    workers stay for the next tasks, and what they hold on to counts against the executor."""

    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)
