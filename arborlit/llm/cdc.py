"""Document fingerprints by content-defined chunking.

A gear hash runs over the bytes of a text: each step shifts the hash and adds
the byte's code, so it depends on the last ``GEAR_BYTES`` bytes only and is
computed here for all bytes at once by doubling; a text is taken to follow
``GEAR_BYTES`` zero bytes.  A chunk ends where the hash has
``strict`` zero bits, from ``normal`` bytes on where it has ``loose`` of them
(normalised chunking), and at ``longest`` bytes at the latest.  An insertion
moves boundaries near it only, so the chunks elsewhere keep their digests.

A fingerprint is the set of a text's chunk digests, each with its chunk's
length; likeness is the length of the shared chunks over that of the smaller
set, the containment of the one in the other.
"""

from __future__ import annotations

from base64 import b64encode
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.llm.session import bounded_batches
from arborlit.llm.textblocks import U64, mix, prefix_sums, span_hashes

GEAR_BYTES = 16
_GEAR = (mix(np.arange(1, 257, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) >> U64(32)).astype(np.uint32)
_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x165667B19E3779F9))
BLOCK_CHARS = 1 << 20
COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
ENTRY = np.dtype([("digest", ">u8"), ("length", ">u2")])


@dataclass(frozen=True)
class Chunking:
    """Chunk sizes in bytes, and how many zero bits end a chunk before and after the normal size."""

    shortest: int = 12
    normal: int = 32
    longest: int = 128
    strict: int = 6
    loose: int = 4


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the codes of it and the bytes before, each shifted by its distance, over ``GEAR_BYTES``."""
    out, step = _GEAR[data], 1
    while step < GEAR_BYTES:
        out[step:] += out[:-step] << np.uint32(step)  # the right side is taken before the sum
        step *= 2
    return out


def boundaries(data: np.ndarray, offsets: np.ndarray, how: Chunking) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the chunks of texts that lie one after another; every text is cut at its own ends."""
    hashes = gear_hashes(data)
    strict = np.flatnonzero(hashes >> np.uint32(32 - how.strict) == 0) + 1
    loose = np.flatnonzero(hashes >> np.uint32(32 - how.loose) == 0) + 1
    end_of_all = len(data) + how.longest + 1
    strict, loose = np.append(strict, end_of_all), np.append(loose, end_of_all)
    row = np.flatnonzero(np.diff(offsets))
    at, last = offsets[row], offsets[row + 1]
    starts, ends, rows = [], [], []
    while len(row):  # every text takes its next chunk
        first = strict[np.searchsorted(strict, at + how.shortest)]
        later = loose[np.searchsorted(loose, at + how.normal)]
        end = np.minimum(np.minimum(np.where(first < at + how.normal, first, later), at + how.longest), last)
        starts.append(at)
        ends.append(end)
        rows.append(row)
        on = end < last
        at, last, row = end[on], last[on], row[on]
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(rows)


def fingerprints(texts: list[bytes], how: Chunking) -> list[np.ndarray]:
    """Each text's distinct chunks as ascending (digest, length) entries."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
    # a text's first hashes must not depend on the text before it
    apart = np.zeros(len(data) + GEAR_BYTES * len(texts), dtype=np.uint8)
    shift = GEAR_BYTES * np.arange(1, len(texts) + 1)
    apart[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
    padded = np.empty(2 * len(texts) + 1, dtype=np.int64)
    padded[0::2] = np.concatenate((offsets[:-1] + shift - GEAR_BYTES, [len(apart)]))
    padded[1::2] = offsets[:-1] + shift
    starts, ends, rows = boundaries(apart, padded, how)
    own = rows % 2 == 1
    starts, ends, rows = starts[own], ends[own], rows[own] // 2
    digest = span_hashes(prefix_sums(_CODES[apart]), starts, ends)
    order = np.lexsort((digest, rows))
    digest, rows, length = digest[order], rows[order], (ends - starts)[order]
    keep = np.ones(len(rows), dtype=bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (digest[1:] != digest[:-1])
    entries = np.empty(int(keep.sum()), dtype=ENTRY)
    entries["digest"], entries["length"] = digest[keep], length[keep]
    return np.split(entries, np.searchsorted(rows[keep], np.arange(1, len(texts))))


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Length of the shared chunks over that of the smaller set; two empty sets are alike, one is unlike any other."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    _, at, _ = np.intersect1d(x["digest"], y["digest"], assume_unique=True, return_indices=True)
    return float(x["length"][at].sum(dtype=np.int64)) / float(min(x["length"].sum(dtype=np.int64), y["length"].sum(dtype=np.int64)))


def fingerprint(docs: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """(doc_id, fingerprint) for each row of ``docs`` (doc_id bigint, text string).

    A fingerprint is base 64 of 8 bytes of digest and 2 of length a chunk, in
    digest order; equal texts have equal ones, null and empty texts the empty one.
    Null ids stay, repeated rows are rows of their own, other columns are ignored,
    an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = fingerprints([(x or "").encode() for x in part.column(1).to_pylist()], how)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([b64encode(x.tobytes()).decode() for x in found], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def edit_audit(docs: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness, in doc_id order.

    The edited text is the text with its last floor(n_chars / 4) code points
    replaced by the first as many (or all) of the next row's text by ascending
    doc_id, the last row's next being the first.  Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited (likeness of text
    and edited text), near_next (likeness of text and next text).

    Rows are dealt into ranges of doc_id, so one shuffle of the texts brings
    neighbours together, and each range also gets the first row of the one after
    it.  Equal doc_ids are ordered by text and lie in one range.  Null texts count
    as empty; a row with a null doc_id has an empty next text; a single row is
    its own next; other columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = sorted(set(rows.approxQuantile("doc_id", [k / count for k in range(1, count)], 1 / (8 * count)))) if count > 1 else []
    # how many cuts lie below an id, by binary search; rows without id have no neighbours and lie anywhere
    held = F.array(*map(F.lit, cuts)).cast("array<double>")
    steps = F.array(*(F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1))) if cuts else F.array().cast("array<int>")
    found = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(held, low + step - 1) < F.col("doc_id"), low + step).otherwise(low))
    part = F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(count))).otherwise(found)
    placed = rows.withColumn("part", part.cast("int"))
    first = sorted(tuple(x) for x in placed.where("part >= 0").groupBy("part").agg(F.min("doc_id")).collect())  # a row for each range
    after = [(p, first[(k + 1) % len(first)][1]) for k, (p, _) in enumerate(first)]
    after = F.broadcast(spark.createDataFrame(after, "target int, doc_id long"))
    edge = rows.join(after, "doc_id").groupBy(F.col("target").alias("part"), "doc_id").agg(F.min("text").alias("text"))
    both = placed.withColumn("edge", F.lit(False)).unionByName(edge.withColumn("edge", F.lit(True)))
    dealt = both.repartitionByRange(count, "part").sortWithinPartitions("part", "edge", "doc_id", "text").select("doc_id", "text", "part", "edge")

    def audit(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, and but those that are there as another's next."""
        told = [(a[0], a[1], b[1] if a[2] == b[2] and a[2] >= 0 else "") for a, b in zip(rows, rows[1:], strict=False) if not a[3]]
        own = fingerprints([x[1].encode() for x in rows], how)
        own = [(x, y) for x, y, a in zip(own, own[1:], rows, strict=False) if not a[3]]
        changed = [edited(text, following).encode() for _, text, following in told]
        prints = fingerprints(changed, how) if changed else []
        none = np.zeros(0, dtype=ENTRY)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in told], pa.int64()),
                pa.array([len(x[1]) for x in told], pa.int64()),
                pa.array([sha256(x).hexdigest() for x in changed], pa.string()),
                pa.array([b64encode(x.tobytes()).decode() for x, _ in own], pa.string()),
                pa.array([b64encode(x.tobytes()).decode() for x in prints], pa.string()),
                pa.array([likeness(x, y) for (x, _), y in zip(own, prints, strict=True)], pa.float64()),
                pa.array([likeness(x, y if t[0] is not None else none) for (x, y), t in zip(own, told, strict=True)], pa.float64()),
            ],
            names=COLUMNS,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                held.append(row)
                size += len(row[1])
                if size >= BLOCK_CHARS and len(held) > 1:
                    yield audit(held)
                    held, size = held[-1:], len(row[1])
        if held:
            yield audit([*held, (None, "", -1, True)])

    kinds = ("long", "long", "string", "string", "string", "double", "double")
    return dealt.mapInArrow(run, ", ".join(map(" ".join, zip(COLUMNS, kinds, strict=True))))
