"""Sorted keys in packed blocks: how tasks exchange many small records as few rows."""

import numpy as np
import zstandard

LEVEL = 1


def _planes(values: np.ndarray) -> bytes:
    """The bytes of fixed-width integers, first bytes first: high bytes that are mostly zero pack to nothing."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def _from_planes(data: memoryview, kind, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, dtype=np.uint8, count=n * width).reshape(width, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit keys, as differences, with columns of unsigned integers."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype(np.uint64)
    kinds = "".join(c.dtype.char for c in columns).encode().ljust(8)
    parts = [np.uint64(len(keys)).tobytes(), kinds, _planes(gaps), *[_planes(c) for c in columns]]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(parts))


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    plain = memoryview(zstandard.ZstdDecompressor().decompress(data))
    n = int(np.frombuffer(plain[:8], dtype=np.uint64)[0])
    kinds = bytes(plain[8:16]).decode().strip()
    out, at = [np.cumsum(_from_planes(plain[16:], np.uint64, n), dtype=np.uint64)], 16 + 8 * n
    for kind in kinds:
        out.append(_from_planes(plain[at:], np.dtype(kind), n))
        at += n * np.dtype(kind).itemsize
    return tuple(out)


def bounds(parts: int) -> np.ndarray:
    """The smallest key of every part but the first: equal ranges of 64-bit keys."""
    return np.array([i * (1 << 64) // parts for i in range(1, parts)], dtype=np.uint64)


def cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where ascending keys begin a part; one more entry for the end."""
    return np.concatenate([[0], np.searchsorted(keys, bounds(parts)), [len(keys)]]).astype(np.int64)


def small(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the narrowest unsigned type."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(top))
