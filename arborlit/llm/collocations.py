"""Collocations by hash filtering (PCY, DHP) and Apriori pruning.

Phrases of one to four words are counted in one pass over the texts a length.
While the pass for length k counts its phrases exactly, it also counts phrases of
length k + 1 by hash bucket, of those only whose two parts may be frequent.  The
next pass counts a phrase only if its bucket is full enough and both parts were
frequent; both facts travel as bitmaps of a fixed size.  Bitmaps let false ones
through and never drop a frequent phrase, and the counts themselves are kept by
the phrases' own words, so results are exact (Park, Chen and Yu, 1995).

Counts travel packed, a row for each block of text and part of the hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from arborlit.llm import bitmaps, packed
from arborlit.llm.ranking import positions
from arborlit.llm.session import bounded_batches, durable, parts
from arborlit.llm.textblocks import U64, Block, blocks, mix, prefix_sums, runs, span_hashes

FLUSH_BYTES = 4 << 20
BROADCAST_LANGS = 10_000
WORD, SPACE, BREAK = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
PHRASES, FULL, FREQUENT = 0, 1, 2
SENT = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("at", pa.binary()), ("text", pa.binary()), ("n", pa.binary())])
COUNTED = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64()), ("at", pa.binary()), ("bits", pa.binary())])


def strings(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of spans one after another, and where each begins (and the end)."""
    offsets = np.concatenate(([0], np.cumsum(size)))
    return data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])], offsets


@dataclass
class Text:
    """The words of a block: exact code and hash of each by language and word, and the number of the piece that it lies in."""

    code: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray
    row: np.ndarray
    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def whole(self, width: int) -> np.ndarray:
        """For each place, whether ``width`` words from there lie in one piece."""
        n = max(0, len(self.piece) - width + 1)
        return self.piece[:n] == self.piece[width - 1 :]


def read(block: Block, langs: list[bytes]) -> Text:
    data = _LOWER[block.data]
    kind = _KIND[data]
    found = runs(block, kind == WORD)
    if not len(found.start):
        none = np.zeros(0, dtype=np.int64)
        return Text(none, none.astype(U64), none, none, data, none, none)
    row = np.repeat(np.arange(len(block)), np.diff(found.first))
    size = found.end - found.start
    piece = np.cumsum(kind == BREAK, dtype=np.int32)[found.start] + row  # both grow, so the sum is equal within a piece only
    flat, offsets = strings(data, found.start, size)
    named = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)]).dictionary_encode()
    used = named.dictionary
    at, held = np.frombuffer(used.buffers()[1], dtype=np.int64)[: len(used) + 1], np.frombuffer(used.buffers()[2], dtype=np.uint8)
    word = named.indices.to_numpy().astype(np.int64)
    sums = prefix_sums(mix(held.astype(U64) + U64(1)))
    hashes = span_hashes(sums, at[:-1], at[1:])
    distinct = sorted(set(langs))
    number = {x: k for k, x in enumerate(distinct)}
    lang = np.array([number[x] for x in langs], dtype=np.int64)[row]
    seeds = np.concatenate([span_hashes(prefix_sums(mix(np.frombuffer(x, dtype=np.uint8).astype(U64) + U64(1))), np.array([0]), np.array([len(x)])) for x in distinct])
    return Text(lang * len(used) + word, mix(hashes[word] + seeds[lang]), piece, row, data, found.start, size)


def gram_hashes(text: Text, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place."""
    out = text.hashes
    for k in range(1, width):
        out = mix(out[: len(out) - 1] * U64(0x9E3779B97F4A7C15) + text.hashes[k:]) if len(out) > 1 else out[:0]
    return out


def gram_codes(text: Text, at: np.ndarray, width: int) -> np.ndarray:
    """A number for the ``width`` words from each of these places, equal for equal words only."""
    out = text.code[at]
    for k in range(1, width):
        more = text.code[at + k]
        _, dense = np.unique(out, return_inverse=True)
        out = dense * (int(more.max(initial=0)) + 1) + more
    return out


def gram_strings(text: Text, at: np.ndarray, width: int, langs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Language, a line feed (no phrase holds one) and the words joined by one space, of each place."""
    names = np.frombuffer(b"".join(langs) + b" \n", dtype=np.uint8)
    ends = np.cumsum([len(x) for x in langs])
    sizes = np.array([len(x) for x in langs], dtype=np.int64)
    data, base = np.concatenate((text.data, names)), len(text.data)
    row = text.row[at]
    start, size = [base + (ends - sizes)[row], np.full(len(at), base + len(names) - 1)], [sizes[row], np.ones(len(at), dtype=np.int64)]
    for k in range(width):
        if k:
            start.append(np.full(len(at), base + len(names) - 2))
            size.append(np.ones(len(at), dtype=np.int64))
        start.append(text.start[at + k])
        size.append(text.size[at + k])
    flat, offsets = strings(data, np.stack(start, 1).ravel(), np.stack(size, 1).ravel())
    return flat, offsets[:: len(start)]


@dataclass(frozen=True)
class Filters:
    """By length: bitmaps of the buckets that are full enough, and of the phrases found frequent."""

    full: dict[int, np.ndarray]
    frequent: dict[int, np.ndarray]

    def may_be_frequent(self, text: Text, width: int) -> np.ndarray:
        """For each place, whether the ``width`` words from there lie in one piece and may be a frequent phrase."""
        out = text.whole(width)
        if width in self.full:
            out[out] = bitmaps.test(self.full[width], gram_hashes(text, width)[out])
        if width - 1 in self.frequent:
            at = np.flatnonzero(out)
            hashes = gram_hashes(text, width - 1)
            out[at] = bitmaps.test(self.frequent[width - 1], hashes[at]) & bitmaps.test(self.frequent[width - 1], hashes[at + 1])
        return out


def pack_phrases(text: Text, at: np.ndarray, width: int, langs: list[bytes], n_parts: int) -> Iterator[tuple]:
    """Counts of the phrases at these places, a row a part."""
    codes = gram_codes(text, at, width)
    _, first, n = np.unique(codes, return_index=True, return_counts=True)
    at = at[first]
    place = packed.place(gram_hashes(text, width)[at], n_parts)
    order = np.argsort(place)
    edges = packed.bounds(place[order], n_parts)
    flat, offsets = gram_strings(text, at[order], width, langs)
    n, size = n[order].astype(np.uint32), np.diff(offsets).astype(np.uint32)
    for part in np.flatnonzero(np.diff(edges)).tolist():
        low, high = edges[part], edges[part + 1]
        yield part, PHRASES, packed.squeeze(size[low:high]), zipped(flat[offsets[low] : offsets[high]].tobytes()), packed.squeeze(n[low:high])


def pack_buckets(hashes: np.ndarray, bits: int, n_parts: int) -> Iterator[tuple]:
    """How many of these hashes lie in each of 2**bits buckets, a row a part."""
    place = np.sort(hashes >> U64(64 - bits))
    starts = packed.run_starts(place)
    n = np.diff(np.append(starts, len(place))).astype(np.uint32)
    place = place[starts]
    edges = np.searchsorted(place, (np.arange(n_parts + 1) << bits) // n_parts)
    for part in np.flatnonzero(np.diff(edges)).tolist():
        low, high = edges[part], edges[part + 1]
        yield part, FULL, packed.pack_sorted(place[low:high].astype(np.uint32)), None, packed.squeeze(n[low:high])


def bit_words(place: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending bit numbers as packed numbers of 64-bit words and the words."""
    words = place.astype(U64) >> U64(6)
    starts = packed.run_starts(words)
    return packed.pack_sorted(words[starts].astype(np.uint32)), packed.squeeze(np.bitwise_or.reduceat(U64(1) << (place.astype(U64) & U64(63)), starts))


def zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def records(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def merged_phrases(table: pa.Table, width: int, least: int, bits: int) -> list[tuple]:
    """The phrases of a part that are frequent, the words of languages counted there, and the frequent ones' bitmap."""
    size = np.concatenate([packed.unsqueeze(x, np.uint32) for x in table["at"].to_pylist()])
    text = b"".join(map(unzipped, table["text"].to_pylist()))
    keys = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(size, dtype=np.int64)))), pa.py_buffer(text)])
    n = np.concatenate([packed.unsqueeze(x, np.uint32) for x in table["n"].to_pylist()]).astype(np.int64)
    summed = pa.table({"key": keys, "n": n}).group_by("key").aggregate([("n", "sum")])
    summed = summed.filter(pc.or_(pc.greater_equal(summed["n_sum"], least), pc.ends_with(summed["key"], "\n")))
    out = []
    for key, count in zip(summed["key"].to_pylist(), summed["n_sum"].to_pylist(), strict=True):
        lang, _, phrase = key.rpartition("\n")
        out.append((PHRASES, lang, phrase, count, None, None))
    if named := [(lang.encode(), phrase.encode()) for _, lang, phrase, *_ in out if phrase]:
        langs, phrases = zip(*named, strict=True)
        ends = np.cumsum([0, *map(len, phrases)])
        again = read(Block(np.array(langs, dtype=object), np.frombuffer(b"".join(phrases), dtype=np.uint8), ends), list(langs))
        place = np.unique(gram_hashes(again, width)[np.arange(len(phrases)) * width] >> U64(64 - bits))
        out.append((FREQUENT, None, None, None, *bit_words(place)))
    return out


def merged_buckets(table: pa.Table, least: int) -> list[tuple]:
    """The bitmap of the buckets of a part that hold ``least`` or more."""
    place = np.concatenate([packed.unpack_sorted(x) for x in table["at"].to_pylist()])
    n = np.concatenate([packed.unsqueeze(x, np.uint32) for x in table["n"].to_pylist()]).astype(np.int64)
    order = np.argsort(place, kind="stable")
    starts = packed.run_starts(place[order])
    full = place[order][starts][np.add.reduceat(n[order], starts) >= least]
    return [(FULL, None, None, None, *bit_words(full))] if len(full) else []


def count_pass(docs: DataFrame, width: int, longest: int, filters: Filters, least: int, bits: int) -> DataFrame:
    """(kind, lang, phrase, n, at, bits): the frequent phrases of ``width`` words by language, and the bitmaps for the next pass.

    The first pass also gives each language's number of words, by part, as the
    phrase without words.
    """
    spark = docs.sparkSession
    n_parts = parts(spark)
    shared = spark.sparkContext.broadcast(filters)  # bitmaps of 2**bits bits, two a length

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for block in blocks(batches, "lang", "text", FLUSH_BYTES):
            langs = [x.encode() for x in block.ids]
            text = read(block, langs)
            able = shared.value.may_be_frequent(text, width)
            rows = list(pack_phrases(text, np.flatnonzero(able), width, langs, n_parts))
            if width == 1:
                words: Counter = Counter()
                for x, n in zip(langs, np.bincount(text.row, minlength=len(langs)).tolist(), strict=True):
                    words[x + b"\n"] += n
                rows.append((turn % n_parts, PHRASES, packed.squeeze(np.array([len(x) for x in words], dtype=np.uint32)), zipped(b"".join(words)), packed.squeeze(np.array([*words.values()], dtype=np.uint32))))
                turn += 1
            if width < longest:
                longer = text.whole(width + 1)
                longer &= able[: len(longer)] & able[1 : len(longer) + 1]
                rows += pack_buckets(gram_hashes(text, width + 1)[longer], bits, n_parts)
            yield from records(rows, SENT).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        out = []
        for kind, merged in ((PHRASES, lambda x: merged_phrases(x, width, least, bits)), (FULL, lambda x: merged_buckets(x, least))):
            held = table.filter(pc.equal(table["kind"], kind))
            out += merged(held) if held.num_rows else []
        return records(out, COUNTED)

    sent = docs.mapInArrow(send, from_arrow_schema(SENT))
    return durable(sent.groupBy("part").applyInArrow(merge, from_arrow_schema(COUNTED)))


def collected(counted: DataFrame, kind: int, bits: int) -> np.ndarray:
    """The whole bitmap of a kind; its size is fixed."""
    out = np.zeros(1 << (bits - 6), dtype=U64)
    for at, words in counted.where(F.col("kind") == kind).select("at", "bits").collect():  # 2**bits bits at most
        out[packed.unpack_sorted(bytes(at))] |= packed.unsqueeze(bytes(words), U64)
    return out


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4, bits: int = bitmaps.BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, width, f) of the phrases that occur ``least`` times in a language, and (lang, n): its words.

    ``docs`` has lang (null: ``und``) and text.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found, filters = [], Filters({}, {})
    for width in range(1, longest + 1):
        counted = count_pass(texts, width, longest, filters, least, bits)
        found.append(counted.where(F.col("kind") == PHRASES).select("lang", "phrase", F.lit(width).alias("width"), F.col("n").alias("f")))
        if width < longest:
            filters = Filters(filters.full | {width + 1: collected(counted, FULL, bits)}, filters.frequent | {width: collected(counted, FREQUENT, bits)})
    every = reduce(DataFrame.unionByName, found)
    return every.where("phrase <> ''"), found[0].where("phrase = ''").groupBy("lang").agg(F.sum("f").alias("n"))


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, width, a, l, r, score) of the phrases of two words or more, each by its lowest-scoring cut.

    Parts of a frequent phrase are frequent, so every cut finds its counts.
    """
    held = frequent.select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    cuts = frequent.where("width > 1").select("lang", "phrase", "width", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("width")), " ")})
    cuts = cuts.join(held.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(held.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(2000000 * CAST(a AS DECIMAL(30, 0))) DIV (l + r)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "width", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "width", "a", "cut.l", "cut.r", "cut.score")


def kept(candidates: DataFrame, cover: int = 80) -> DataFrame:
    """The candidates that no longer one holds contiguously in at least ``cover`` percent of their occurrences."""
    words, size = F.split("phrase", " "), F.col("width")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda k: F.array_join(F.slice(words, k, n), " "))))
    held = candidates.where("width > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("longer"))
    most = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.expr(f"CAST(longer AS DECIMAL(30, 0)) * 100 >= CAST(a AS DECIMAL(30, 0)) * {int(cover)}")
    return candidates.join(most, ["lang", "phrase"], "left").where(F.coalesce(~covered, F.lit(True))).drop("longer")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, cover: int = 80, top: int = 2000, bits: int = bitmaps.BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of ``docs`` (lang, text).

    A-Z count as lower case.  Texts are cut into pieces at ``. , ; : ! ?`` and
    line ends, pieces into words at spaces and tabs.  Candidates are phrases of 2
    to ``longest`` words that occur ``least`` times within pieces, overlaps
    counted.  A cut of one into two parts that occur l and r times scores
    floor(2000000 a / (l + r)); the lowest cut counts, ties to the earliest.
    Ranks go by score, a, then the phrase's UTF-8 bytes.

    Null texts count as empty, null languages as ``und``; repeated rows count as
    often as they are there; other columns are ignored; an empty table gives an
    empty result.
    """
    frequent, totals = frequent_phrases(docs, least, longest, bits)
    candidates = durable(kept(scored(frequent), cover))
    placed = positions(candidates, [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")])
    first = durable(placed.groupBy("lang").agg(F.min("position").alias("first")).join(totals, "lang"))
    few = first.count() <= BROADCAST_LANGS  # one language may have most rows, so they stay where they are unless languages are very many
    ranked = placed.join(F.broadcast(first) if few else first, "lang").withColumn("rank", F.col("position") - F.col("first") + 1)
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
