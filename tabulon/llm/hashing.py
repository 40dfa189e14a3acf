"""Words and their hashes as NumPy arrays, straight from UTF-8 bytes.

A word is a run of bytes other than space and 0x09 to 0x0D, which is the same as the pattern
``[^\\x20\\x09-\\x0D]+`` on the text. Hashes are polynomials modulo 2**64 over random byte values,
followed by a bit mixer. They depend on nothing but the text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def inverse(odd: int) -> int:
    return pow(int(odd), -1, 1 << 64)


@lru_cache(8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def powers(base, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    size = 1 << max(12, int(n).bit_length())
    return _powers(int(base), size)[:n]


def before(values: np.ndarray) -> np.ndarray:
    """Sums of all values before each place, and of all at the end."""
    out = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=out[1:])
    return out


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the number of words before it."""
    n = len(data)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = solid[1:] & (~solid[:-1] | first)
    end = solid[:-1] & (~solid[1:] | first)
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    if not len(starts):
        return np.zeros(0, U64)
    values = BYTE_VALUES[data]
    values *= powers(BASE, len(data))
    sums = before(values)
    spans = (sums[ends] - sums[starts]) * powers(inverse(BASE), len(data) + 1)[starts]
    return mix(spans + (ends - starts).astype(U64))


def gram_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words; the caller drops runs that cross rows."""
    n = len(words)
    if n < size:
        return np.zeros(0, U64)
    base = U64(0xD6E8FEB86659FD93 + 2 * seed)
    values = words if not seed else mix(words + U64(seed))
    sums = before(values * powers(base, n))
    return mix((sums[size:] - sums[:-size]) * powers(inverse(base), n + 1)[: n - size + 1])


def rows_of(row_words: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(row_words) - 1), np.diff(row_words))


def inside(row_words: np.ndarray, size: int) -> np.ndarray:
    """Starts of the runs of ``size`` words that lie in one row."""
    total = int(row_words[-1])
    if total < size:
        return np.zeros(0, np.int64)
    row_end = np.repeat(row_words[1:], np.diff(row_words))
    start = np.arange(total - size + 1)
    return start[start + size <= row_end[: total - size + 1]]
