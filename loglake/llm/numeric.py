"""Texts of an Arrow batch as arrays of bytes, words and hashes.

All of it works on a stretch of rows at a time, bounded in bytes, so that what a task holds
does not depend on the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STRETCH = 1 << 19
_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_SEED.integers(0, 2**63)) * 2 + 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def stretches(texts: pa.Array, limit: int = STRETCH) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row bounds within the bytes); a longer text comes alone."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def class_table(*separators: tuple[int, int]) -> np.ndarray:
    """True for bytes of words: those in none of the ranges. Non-ASCII bytes belong to words."""
    table = np.ones(256, bool)
    for first, last in separators:
        table[first : last + 1] = False
    return table


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends where its row ends."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = inside.copy(), np.zeros(len(inside) + 1, bool)
    starts[1:] &= ~inside[:-1]
    ends[1:-1] = inside[:-1] & ~inside[1:]
    ends[-1] = inside[-1]
    inner = bounds[(bounds > 0) & (bounds < len(inside))]
    starts[inner] |= inside[inner]
    ends[inner] |= inside[inner - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends)


class SpanHash:
    """64-bit hashes of spans of bytes, from running sums of byte values times powers."""

    def __init__(self, salt: int = 0) -> None:
        self.base = (_BASE + 2 * salt * 0x51ED270B) % 2**64
        self.bytes = _BYTE if not salt else mix(_BYTE + np.uint64(salt))
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 2**64))):
                factors = np.full(max(size, STRETCH + 1), base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.bytes[data] * self.powers[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hash(values: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each k consecutive values (one fewer than k at the end have none)."""
    count = len(values) - k + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    weights = np.random.default_rng(77 + salt).integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total = values[:count] * weights[0]
    for j in range(1, k):
        total += values[j : j + count] * weights[j]
    return mix(total)


def minhash_functions(count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of multiply-add hashes of 32 bits."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors, rng.integers(0, 2**32, count, dtype=np.uint32)


def minima(values: np.ndarray, starts: np.ndarray, count: int, seed: int = 5) -> np.ndarray:
    """MinHash: for each group of values the minima of `count` multiply-add hashes, (groups, count)."""
    factors, shifts = minhash_functions(count, seed)
    folded = (values >> np.uint64(32)).astype(np.uint32)
    result = np.empty((count, len(starts)), np.uint32)
    for i in range(count):
        result[i] = np.minimum.reduceat(folded * factors[i] + shifts[i], starts)
    return np.ascontiguousarray(result.T)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of `rows` minima, (groups, bands)."""
    groups, count = signatures.shape
    bands = count // rows
    weights = np.random.default_rng(99).integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    parts = signatures[:, : bands * rows].reshape(groups, bands, rows).astype(np.uint64)
    return mix(mix((parts + np.uint64(1)) * weights).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    """A list array of values cut into lists of the sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
