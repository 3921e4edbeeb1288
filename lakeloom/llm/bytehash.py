"""Vectorised hashes over the byte buffers of Arrow string columns.

``Fingerprints`` are polynomials modulo the prime 2**61 - 1 of every range of a buffer, from one
running sum: with ``S[j] = sum(v[t] * B**t for t < j)`` the range ``[i, e)`` has
``(S[e] - S[i]) * B**-i``, which does not depend on where the range stands. Two different ranges of
``n`` bytes are equal for at most ``n`` of the 2**61 bases. (Modulo a power of two, no base tells
the Thue-Morse string from its complement.) ``word_hashes`` takes short ranges eight bytes at a
time through a mixer, and ``grams`` is a quick rolling hash of fixed length that only chooses
places, never tells strings apart.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PRIME = (1 << 61) - 1
_P, _U = np.uint64(PRIME), np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
BASES = [int(x) for x in _RNG.integers(1 << 58, PRIME, 2, dtype=np.int64)]
VALUES = [_RNG.integers(1, 1 << 30, 256, dtype=np.uint64) for _ in BASES]
_GRAM_BASE = int(_RNG.integers(1 << 40, 1 << 62)) | 5
_GRAM_VALUES = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` below 2**64, modulo the prime."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    """``x * 2**bits`` modulo the prime, for reduced ``x``; at most the prime."""
    return ((x << _U(bits)) & _P) | (x >> _U(61 - bits))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of reduced numbers, by halves of 31 and 30 bits."""
    low31, low30 = _U((1 << 31) - 1), _U((1 << 30) - 1)
    a1, a0, b1, b0 = a >> _U(31), a & low31, b >> _U(31), b & low31
    middle = a1 * b0 + a0 * b1  # below 2**62
    # a1 * b1 * 2**62 = a1 * b1 * 2; middle * 2**31 = (middle >> 30) * 2**61 + (middle & low30) * 2**31
    return _reduced(_reduced(a0 * b0) + ((a1 * b1) << _U(1)) + (middle >> _U(30)) + ((middle & low30) << _U(31)))


def _prime_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime; kept and grown per process."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.ones(1, np.uint64)
        while len(have) < size:  # doubled each time
            step = np.full(1, pow(base, len(have), PRIME), np.uint64)
            have = np.concatenate([have, times(have, step)])
        _POWERS[base] = have
    return have[:n]


def _wrapping_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown per process."""
    have = _POWERS.get(-base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _POWERS[-base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


class Fingerprints:
    """Fingerprints of the ranges of one buffer, of family 0 or 1; 61 bits each."""

    def __init__(self, data: np.ndarray, family: int = 0):
        n, base = len(data), BASES[family]
        powers, value = _prime_powers(base, n), VALUES[family][data]
        # value * power by halves of the power: below 2**61 and 2**60
        high, low = value * (powers >> _U(30)), value * (powers & _U((1 << 30) - 1))
        term = _reduced(_rotated(_reduced(high), 30) + low)
        self.sums = np.zeros(n + 1, np.uint64)
        # running sums of 31-bit halves cannot overflow below 2**33 bytes
        upper, lower = np.cumsum(term >> _U(31)), np.cumsum(term & _U((1 << 31) - 1))
        self.sums[1:] = _reduced(_rotated(_reduced(upper), 31) + _reduced(lower))
        self.inverse = _prime_powers(pow(base, -1, PRIME), n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return times(_reduced(self.sums[end] + _P - self.sums[start]), self.inverse[start])


def grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ranges [i, i + k), for every i that leaves room."""
    n = len(data) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_GRAM_VALUES[data] * _wrapping_powers(_GRAM_BASE, len(data)), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * _wrapping_powers(pow(_GRAM_BASE, -1, 1 << 64), n))


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the ranges [begin, end), eight bytes at a time; work grows with the bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # those that start at each byte
    keep = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    size = end - begin
    out = mix(size.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
    live, at = np.arange(len(begin)), 0
    while len(live):
        rest = size[live] - at
        out[live] = mix(out[live] * _U(0xC2B2AE3D27D4EB4F) ^ (eights[begin[live] + at] & keep[np.minimum(rest, 8)]))
        at += 8
        live = live[rest > 8]
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) whose texts fill at most ``limit`` bytes; a longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes batches on; at their end gives kept tables and free memory back, as idle workers live on."""
    yield from batches
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
