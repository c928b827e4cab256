"""Columns of integers as one compact binary value, so that a shuffle moves blocks instead of rows."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(*columns: np.ndarray) -> bytes:
    """Byte planes of each column (first all lowest bytes, ..), compressed; columns may differ in length and type."""
    head, body = [], []
    for c in columns:
        c = np.ascontiguousarray(c)
        head.append(struct.pack("<2sq", c.dtype.str[1:].encode(), len(c)))
        body.append(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(bytes([len(columns)]) + b"".join(head + body))


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    at, kinds = 1 + 10 * data[0], []
    for i in range(data[0]):
        kind, n = struct.unpack_from("<2sq", data, 1 + 10 * i)
        kinds.append((np.dtype("<" + kind.decode()), n))
    out = []
    for dtype, n in kinds:
        size = dtype.itemsize * n
        planes = np.frombuffer(data, np.uint8, size, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(n))
        at += size
    return out


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash by its highest bits, so that buckets are ranges of hashes; at most 2 ** 31 buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
