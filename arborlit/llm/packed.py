"""Packed exchange: many small keyed entries travel as a few binary rows.

A mapper sorts its entries by (part, key), and ships one row for each part that
it has entries for.  A reducer gets all rows of a part as one Arrow table.  The
number of entries in a part is the corpus's share, whatever the keys, as parts
are taken from well-mixed hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from arborlit.llm.textblocks import U64

LOW = U64(0xFFFFFFFF)


def place(hashes: np.ndarray, n_parts: int) -> np.ndarray:
    """(part << 32) | low 32 bits of the hash, the part from its high 32 bits."""
    part = ((hashes >> U64(32)) * U64(n_parts)) >> U64(32)
    return (part << U64(32)) | (hashes & LOW)


def bounds(placed: np.ndarray, n_parts: int) -> np.ndarray:
    """Where each part begins in sorted ``placed``, and its end."""
    return np.searchsorted(placed, np.arange(n_parts + 1, dtype=U64) << U64(32))


def squeeze(values: np.ndarray) -> bytes:
    """The bytes of an array, plane by plane, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unsqueeze(data: bytes, dtype: type) -> np.ndarray:
    """The array of :func:`squeeze`."""
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(dtype)
    planes = pa.decompress(data[8:], decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(kind.itemsize, n).T).reshape(-1).view(kind)


def pack_sorted(low: np.ndarray) -> bytes:
    """Ascending 32-bit keys as compressed gaps."""
    return squeeze(np.diff(low, prepend=low.dtype.type(0)).astype(np.uint32))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint32), dtype=np.uint32)


def run_starts(ordered: np.ndarray) -> np.ndarray:
    """The first index of each run of equal values."""
    if not len(ordered):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
