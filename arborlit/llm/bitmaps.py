"""Bitmaps of a fixed size, used to broadcast membership.

A bitmap answers "perhaps" or "no".  Its size is a parameter and doesn't grow
with the data, so it can be broadcast; a fuller bitmap lets more rows through to
the exact step that follows and never drops one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlit.llm.textblocks import U64

BITS = 26


def collect_bitmap(df: DataFrame, key: Column, bits: int = BITS) -> np.ndarray:
    """A bitmap (uint64 words) of ``xxhash64(key)``; at most ``2**(bits-6)`` rows reach the driver."""
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    bit = place.bitwiseAND(F.lit(63)).cast("int")
    merged = df.select(F.shiftrightunsigned(place, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=U64)
    out[merged.column("w").to_numpy()] = merged.column("b").to_numpy().view(U64)
    return out


def test(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of these 64-bit hashes the bitmap may hold, by their leading bits."""
    place = hashes >> U64(64 - (len(bitmap).bit_length() - 1 + 6))
    return (bitmap[place >> U64(6)] >> (place & U64(63))) & U64(1) == U64(1)
