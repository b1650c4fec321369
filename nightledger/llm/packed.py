"""Arrays of numbers as compact bytes, for rows that carry many values through a shuffle."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_CODES = "<i8 <i4 <u8 <u4 |u1 <f8 <f4 <i2".split()


def pack(*arrays: np.ndarray) -> bytes:
    """Bytes of several arrays, equal-order bytes put together so that small values take little room."""
    parts = [struct.pack("<B", len(arrays))]
    for a in arrays:
        code = _CODES.index(a.dtype.newbyteorder("<").str)
        parts.append(struct.pack("<BQ", code, len(a)))
        parts.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 1
    for _ in range(raw[0]):
        code, n = struct.unpack_from("<BQ", raw, at)
        at += 9
        kind = np.dtype(_CODES[code])
        bytes_ = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(bytes_.T).view(kind).ravel())
        at += n * kind.itemsize
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of neighbours, the first value first; undone by ``np.cumsum``."""
    return np.diff(values, prepend=values.dtype.type(0))
