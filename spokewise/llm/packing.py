"""Arrays of whole numbers as small binary values, for rows that carry many numbers through a shuffle."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_HEAD = struct.Struct("<BQQ")


def pack(*arrays: np.ndarray) -> bytes:
    """Non-negative arrays in their smallest type, byte by byte of rising place, compressed."""
    press = zstandard.ZstdCompressor(level=3)
    parts = []
    for a in arrays:
        kind = np.min_scalar_type(int(a.max()) if len(a) else 0)
        planes = a.astype(kind).view(np.uint8).reshape(len(a), kind.itemsize).T
        body = press.compress(np.ascontiguousarray(planes).tobytes())
        parts.append(_HEAD.pack(kind.itemsize, len(a), len(body)) + body)
    return b"".join(parts)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``; 8-byte ones as uint64, others as int64."""
    out, at, press = [], 0, zstandard.ZstdDecompressor()
    while at < len(data):
        width, n, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        body = press.decompress(data[at:at + size], max_output_size=max(1, n * width))
        at += size
        planes = np.frombuffer(body, np.uint8).reshape(width, n).T
        a = np.ascontiguousarray(planes).reshape(-1).view(f"<u{width}")
        out.append(a if width == 8 else a.astype(np.int64))
    return out


def gaps(rising: np.ndarray) -> np.ndarray:
    """A rising uint64 array as its first value and the differences; ``np.cumsum`` undoes it."""
    return np.diff(rising.astype(np.uint64), prepend=np.uint64(0))


def rising(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.astype(np.uint64), dtype=np.uint64)
