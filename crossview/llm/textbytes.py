"""Vectorised text kernels: words and rolling hashes of many texts at once, on their UTF-8 bytes.

All functions work on a :class:`Texts` block, that is, on the concatenated
bytes of some whole texts with their offsets. Blocks are cut between texts
only, so a text is never split; one that is longer than the block size makes a
block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15 | 1
_MULT_INV = pow(_MULT, -1, 1 << 64)
_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _set(*ranges: tuple[int, int]) -> np.ndarray:
    lut = np.zeros(256, bool)
    for lo, hi in ranges:
        lut[lo : hi + 1] = True
    return lut


#: Bytes of ``[^\x20\x09-\x0D]+`` words.
SPACED = ~_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` words of a lower-cased text, and A-Z, which become such bytes.
ALNUM = ~_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)) | _set((0x41, 0x5A))


@dataclass
class Texts:
    """Texts ``first .. first + n`` of a batch: ``data[offs[i]:offs[i + 1]]`` are the bytes of the i-th."""

    data: np.ndarray
    offs: np.ndarray
    first: int

    @property
    def n(self) -> int:
        return len(self.offs) - 1


@dataclass
class Words:
    """Word k is ``data[start[k]:end[k]]``; text i has the words ``woff[i] .. woff[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    woff: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.woff)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.woff) - 1), self.counts)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Texts]:
    """Cut a string column into blocks of whole texts with about ``size`` bytes each."""
    data, offs = column_bytes(column)
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield Texts(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], i)
        i = j


def words(t: Texts, lut: np.ndarray) -> Words:
    """Maximal runs of the bytes in ``lut``, never across texts."""
    n = len(t.data)
    if not n:
        return Words(np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(t.n + 1, np.int64))
    inside = lut[t.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = t.offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, t.offs))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    return h


def powers(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the hash's base (``up``) or of its inverse (``down``)."""
    have = _powers[kind]
    if len(have) < n:
        base = U64(_MULT if kind == "up" else _MULT_INV)
        have = np.ones(max(n, 2 * BLOCK_BYTES), U64)
        have[1:] = base
        np.cumprod(have, out=have)
        if n <= 2 * BLOCK_BYTES:  # those of a huge text are not kept
            _powers[kind] = have
    return have[:n]


def byte_values(data: np.ndarray) -> np.ndarray:
    """The value of each byte in a polynomial hash."""
    return _BYTE[data]


def prefix_of(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash of any values."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers("up", len(values)), out=out[1:])
    return out


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash of bytes, for :func:`span_hash`."""
    return prefix_of(_BYTE[data])


def span_hash(acc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every span's bytes, the same wherever the bytes stand."""
    return mix((acc[end] - acc[start]) * powers("down", len(acc))[start] + (end - start).astype(U64))


def word_hashes(t: Texts, w: Words, lower: bool = True) -> np.ndarray:
    return span_hash(prefix(LOWER[t.data] if lower else t.data), w.start, w.end)


def windows(h: np.ndarray, w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``n`` consecutive words, and the index of each one's first word."""
    size = len(h) - n + 1
    if size <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    out = h[:size].copy()
    for j in range(1, n):
        out *= U64(0xC2B2AE3D27D4EB4F)
        out += h[j : j + size]
    doc = w.doc
    at = np.flatnonzero(doc[:size] == doc[n - 1 :])
    return mix(out[at]), at


# Arrays as bytes, all first bytes before all second ones and so on, which compresses well.
def planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""


def unplanes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(kind) if raw else np.empty(0, kind)


def keys_out(keys: np.ndarray) -> bytes:
    """Ascending hashes as their differences."""
    return planes(np.diff(keys, prepend=U64(0)))


def keys_in(raw: bytes) -> np.ndarray:
    return np.cumsum(unplanes(raw, U64), dtype=U64)


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values in ascending order, by sorting."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


class HashSet:
    """Sorted 64-bit hashes with a table of their first bits before them, for fast lookups of many values."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(np.asarray(values, U64))
        self.shift = U64(64 - max(10, min(22, int(len(self.values)).bit_length() + 5)))
        top = (self.values >> self.shift).astype(np.int64)
        # Where the members with these first bits begin, -1 without any; how many there are at most.
        self.first = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        self.first[top[::-1]] = np.arange(len(top), dtype=np.int32)[::-1]
        self.deepest = int(np.bincount(top - top[0]).max()) if len(top) else 0

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ``h`` holds a member, and which one, in order."""
        first = self.first[h >> self.shift]
        at = np.flatnonzero(first >= 0)
        k, want = first[at].astype(np.int64), h[at]
        hit = self.values[k] == want if len(at) else np.empty(0, bool)
        rest = np.flatnonzero(~hit)
        for step in range(1, self.deepest):
            if not len(rest):
                break
            other = np.minimum(k[rest] + step, len(self.values) - 1)
            same = self.values[other] == want[rest]
            k[rest[same]] = other[same]
            hit[rest[same]] = True
            rest = rest[~same]
        return at[hit], k[hit]
