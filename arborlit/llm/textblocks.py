"""Vectorised tokenising and hashing of Arrow text columns.

A word is a maximal run of bytes other than ``\\x20 \\x09-\\x0D``.  Texts are
handled in blocks of a few megabytes; a longer single text makes a block of its
own, and no text is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_CODES_LOWER = _BYTE_CODES[_LOWER]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of an odd base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """``out[i]`` = sum of ``values[j] * base**j`` over j < i, modulo 2**64."""
    power, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * power[: len(values)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), equal for equal content wherever it lies."""
    _, inverse = powers(len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


@dataclass
class Block:
    """Some rows: their ids, the bytes of their texts one after another, and where each begins and ends."""

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)


@dataclass
class Words:
    """Byte spans of the words of a block, and for each row the index of its first word (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def text_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], id_column: str = "doc_id", text_column: str = "text", size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of about ``size`` bytes, whole rows only, in the order of the batches."""
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(id_column)).to_numpy(zero_copy_only=False)
        data, offsets = text_parts(batch.column(batch.schema.get_field_index(text_column)))
        low = 0
        while low < len(ids):
            high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
            high = min(max(high, low + 1), len(ids))
            yield Block(ids[low:high], data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            low = high


def runs(block: Block, inside: np.ndarray) -> Words:
    """Maximal runs of bytes for which ``inside`` holds, never across two rows."""
    if not len(block.data):
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(len(block) + 1, dtype=np.int64))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = block.offsets[:-1][block.offsets[:-1] < len(inside)]
    starts[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = block.offsets[1:] - 1
    last = last[last >= 0]
    ends[last] = inside[last]
    start = np.flatnonzero(starts)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, block.offsets))


def words(block: Block) -> Words:
    """The words of each row."""
    return runs(block, ~_SEPARATOR[block.data])


def word_hashes(block: Block, found: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; ``lower``: of its form with A-Z in lower case."""
    codes = _BYTE_CODES_LOWER if lower else _BYTE_CODES
    return span_hashes(prefix_sums(codes[block.data]), found.start, found.end)


def gram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """``out[i]`` hashes the words i to i + width - 1; there are ``len(hashes) - width + 1`` of them."""
    if len(hashes) < width:
        return np.zeros(0, dtype=U64)
    sums = prefix_sums(hashes)
    low = np.arange(len(hashes) - width + 1)
    return span_hashes(sums, low, low + width)


def shingle_sets(block: Block, width: int, lower: bool = True) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingles; a row of fewer words has its whole sequence as the one shingle."""
    found = words(block)
    hashes = word_hashes(block, found, lower)
    grams = gram_hashes(hashes, width)
    counts = np.diff(found.first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    whole = dict(zip(short.tolist(), span_hashes(prefix_sums(hashes), found.first[short], found.first[short + 1]).tolist(), strict=True)) if len(short) else {}
    first = found.first.tolist()
    for row, n in enumerate(counts.tolist()):
        if n >= width:
            ordered = np.sort(grams[first[row] : first[row] + n - width + 1])
            keep = np.ones(len(ordered), dtype=bool)
            keep[1:] = ordered[1:] != ordered[:-1]
            yield ordered[keep]
        elif n:
            yield np.array([whole[row]], dtype=U64)
        else:
            yield np.zeros(0, dtype=U64)
