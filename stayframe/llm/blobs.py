"""Arrays as one compressed binary value."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    """The first arrays of a blob, one for each kind."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    at, out = 8 * (n + 1), []
    for size, kind in zip(np.frombuffer(raw, "<i8", n, 8).tolist(), kinds):
        out.append(np.frombuffer(raw[at:at + size], kind))
        at += size
    return out


def planes(x: np.ndarray) -> np.ndarray:
    """The bytes of unsigned numbers, all lowest first: they compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)


def from_planes(raw: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(f"<u{width}")
