"""Texts of an Arrow batch as flat numpy arrays: words, hashes, ranks of suffixes.

Everything works on slices of bounded size; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000
U = np.uint64

# Bytes that separate words: space and 0x09 to 0x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Bytes outside words of 0-9, a-z and everything beyond ASCII (after lower-casing).
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
# A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def parts(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Consecutive rows of ``batch`` with about ``limit`` bytes in ``column``, and these texts."""
    sizes = pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False).tolist()
    start = size = 0
    for i, length in enumerate([*sizes, limit + 1]):
        if i > start and size + length > limit:
            part = batch.slice(start, i - start)
            yield part, texts_of(part[column])
            start, size = i, 0
        size += length


def joined(texts: list[bytes], separator: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """The texts in one buffer, each followed by ``separator``, and where each begins.

    The second array has one entry more than there are texts.
    """
    buffer = np.frombuffer(separator.join([*texts, b""]), dtype=np.uint8)
    lengths = np.fromiter((len(t) + len(separator) for t in texts), np.int64, len(texts))
    return buffer, np.concatenate([[0], np.cumsum(lengths)])


def word_bounds(buffer: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word in a buffer whose last byte is a gap."""
    inside = np.concatenate([[False], ~gaps[buffer]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every bit depends on every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=U)
    powers[0] = 1
    return np.cumprod(powers, dtype=U)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; lengths are rounded up for reuse."""
    return _powers(base, 1 << max(16, int(n - 1).bit_length()))[:n]


def range_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, equal for equal bytes wherever they stand."""
    n = len(buffer)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(_byte_values()[buffer] * powers(_BASE, n), out=sums[1:])
    moved = (sums[ends] - sums[starts]) * powers(_BASE_INVERSE, n + 1)[starts]
    return mix(moved + (ends - starts).astype(U))


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd constants."""
    return mix(np.arange(1, n + 1, dtype=U) + U(seed << 32)) | U(1)


def paired_ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of the pairs (first, second), both non-negative and below 2**32."""
    n = len(first)
    low = max(1, int(second.max(initial=0)).bit_length())
    high = max(1, int(first.max(initial=0)).bit_length())
    index = max(1, int(n).bit_length())
    keys = (first.astype(U) << U(low)) | second.astype(U)
    if high + low + index <= 64:
        packed = np.sort((keys << U(index)) | np.arange(n, dtype=U))
        order = (packed & U((1 << index) - 1)).astype(np.int64)
        keys = packed >> U(index)
    else:
        order = np.argsort(keys)
        keys = keys[order]
    ranks = np.empty(n, dtype=np.int64)
    ranks[order] = np.cumsum(np.concatenate([[False], keys[1:] != keys[:-1]])) if n else 0
    return ranks


def moved_up(ranks: np.ndarray, by: int) -> np.ndarray:
    """``ranks[i + by] + 1``, and 0 beyond the end."""
    out = np.zeros(len(ranks), dtype=np.int64)
    out[: max(0, len(ranks) - by)] = ranks[by:] + 1
    return out


def spans_to_mask(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True where a position lies in any of the ranges."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(steps)[:n] > 0
