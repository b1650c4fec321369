"""Words and word hashes of many texts at once, computed on the UTF-8 buffer of an Arrow column.

All separators the contracts name are ASCII, so words are runs of bytes; no text becomes a Python
string. Texts are handled in slabs of bounded bytes; a text longer than a slab is a slab of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLAB_BYTES = 2 << 20
LONG_WORD = 64

# Bytes that part words.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

SPACED = np.ones(256, bool)  # [^\x20\x09-\x0D]+
SPACED[list(SPACE_BYTES)] = False

ALNUM = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_RNG = np.random.Generator(np.random.PCG64(20240531))
_BYTE_VALUES = _RNG.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64)
_BASES = [int(x) | 1 for x in _RNG.integers(1 << 60, 1 << 63, size=2, dtype=np.uint64)]
_STEPS = _RNG.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers.get(which, (np.empty(0, np.uint64),) * 2)
    if len(up) < n:
        size = max(n, SLAB_BYTES + 1)

        def series(base: int) -> np.ndarray:
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps)

        up, down = series(_BASES[which]), series(pow(_BASES[which], -1, 1 << 64))
        if size <= 4 * SLAB_BYTES:
            _powers[which] = up, down
    return up, down


class Words:
    """Words of several texts: byte range ``start:end`` of each, ``first[i]:first[i + 1]`` those of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        inside = table[self.data]
        begins, ends = inside.copy(), inside.copy()
        if len(inside):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cut = offsets[1:-1]
            cut = cut[(cut > 0) & (cut < len(inside))]
            begins[cut] = inside[cut]
            ends[cut - 1] = inside[cut - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``which`` 0 and 1 are independent."""
        if not len(self.data):
            return np.empty(0, np.uint64)
        up, down = _power(which, len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[which][self.data] * up[: len(self.data)], out=total[1:])
        length = self.end - self.start
        out = mix((total[self.end] - total[self.start]) * down[self.start] + length.astype(np.uint64))
        for i in np.flatnonzero(length > LONG_WORD):
            word = self.data[self.start[i] : self.end[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=16).digest()[8 * which :][:8], "little")
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def window_starts(words: Words, size: int) -> np.ndarray:
    """Indexes of the words at which ``size`` consecutive words of one text start."""
    limit = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(np.arange(len(words)) + size <= limit)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each start."""
    if not len(starts):
        return np.empty(0, np.uint64)
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += hashes[j : j + n] * _STEPS[which][j]
    return mix(total[starts])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slabs(column: pa.Array, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi`` with their bytes and offsets, at most ``limit`` bytes unless it is one text."""
    data, at = buffers(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def runs(values: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal values."""
    if not len(values):
        return np.empty(0, np.int64)
    change = np.ones(len(values), bool)
    change[1:] = values[1:] != values[:-1]
    return np.flatnonzero(change)
