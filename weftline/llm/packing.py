"""Arrays of whole numbers as short bytes: what crosses the network is packed like this instead of a row for each number."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 to 2**64 - 1, each in as many bytes a number as its largest one needs, equal places of the numbers side by side."""
    head, body = [len(arrays)], []
    for a in arrays:
        a = np.ascontiguousarray(a, "<u8")
        width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        head += [len(a), width]
        body.append(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(np.array(head, "<i8").tobytes() + b"".join(body))


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2).tolist()
    at, found = 8 + 16 * n, []
    for size, width in sizes:
        a = np.zeros((size, 8), np.uint8)
        a[:, :width] = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size).T
        at += size * width
        found.append(a.view("<u8").reshape(-1))
    return found


def steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as their distances, which are smaller numbers."""
    return np.diff(keys, prepend=np.uint64(0))


def from_steps(distances: np.ndarray) -> np.ndarray:
    return np.cumsum(distances, dtype=np.uint64)
