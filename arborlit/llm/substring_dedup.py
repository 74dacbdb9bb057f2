"""Removal of repeated passages by prefix-partitioned suffix trees over words.

A suffix is one for each word that still has ``window`` words before the end of
its text.  Its tree is as deep as ``window`` words: deeper words can't change
which leaves hang below a node of that depth.

1. *Lone leaves.*  Only a suffix whose window occurs elsewhere can hang below a
   deep node.  Every suffix sends a fingerprint of its window and its number
   within its flush (about five bytes) to the fingerprint's part, which answers
   with the numbers of those that have company.  This only leaves suffixes out that
   have none; a false company costs a little work in the next step and no more.
2. *Prefix groups.*  The others are split by variable-length prefixes: by their
   first word where few suffixes of the corpus share it, else by their first two,
   four or eight words, else by the whole window.  The lengths come from counts over
   the whole corpus, in cells whose number grows with it.
3. *Subtrees.*  A suffix arrives with its words, each a 64-bit symbol (its hash;
   frequent ones travel as short numbers).  A group sorts its suffixes by words and
   takes the lengths of common prefixes of neighbours; runs whose common prefix is
   ``window`` long are the leaves below one internal node of that depth.  So windows
   are equal if all their words are; two words could only be taken for each other
   if their 64-bit hashes agree, within windows that are equal otherwise.  Of a
   node's leaves all but those of the smallest doc_id are marked, and touching marks
   make a maximal repeated span.

Before suffixes travel in step 3, each flush compares its own, marks what it can
and ships the leaves of the smallest doc_id only.  So a passage in every text
reaches its group once for each flush.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.llm import bitmaps, packed
from arborlit.llm.session import bounded_batches, durable, free_finished, parts
from arborlit.llm.textblocks import U64, Block, Words, blocks, mix, prefix_sums, span_hashes, text_parts, word_hashes, words

LENGTHS = (1, 2, 4, 8)
CELL_BITS = (12, 22)
FLUSH_PRINTS = 1 << 20
FLUSH_SUFFIXES = 1 << 18
FLUSH_WORDS = 2 << 20
TASK_BYTES = 32 << 20
RANGES, RANGE_WORDS, WORD_BLOCKS = 64, 1 << 14, 16
NO_LEAF = np.uint32(0)


def _starts(found: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The first words of a block's suffixes, and how many suffixes each row has."""
    counts = np.maximum(np.diff(found.first) - window + 1, 0)
    return np.repeat(found.first[:-1] - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum())), counts


def _cells(sums: np.ndarray, first: np.ndarray, length: int, bits: int) -> np.ndarray:
    return (span_hashes(sums, first, first + length) >> U64(64 - bits)).astype(np.int64)


def cell_bits(total: int, group_suffixes: int) -> int:
    """How many cells a prefix length has: 64 for each group that the corpus needs, within ``CELL_BITS``."""
    return min(max(CELL_BITS[0], (64 * total // group_suffixes).bit_length()), CELL_BITS[1])


@dataclass(frozen=True)
class Survey:
    """What a pass over the corpus tells: the heavy cells of prefixes by length, and frequent words' hashes, ascending, with their numbers."""

    heavy: np.ndarray
    words: np.ndarray
    numbers: np.ndarray

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word that has one, else -1."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        if not len(self.words):
            return out
        shift = U64(64 - max(1, len(self.words).bit_length()))
        first = np.searchsorted(self.words >> shift, np.arange(int(U64(2**64 - 1) >> shift) + 1, dtype=U64))
        at, todo = first[hashes >> shift], np.arange(len(hashes))
        while len(todo):  # hashes are even, so a few steps reach each one's place
            here = at[todo]
            inside = here < len(self.words)
            todo, here = todo[inside], here[inside]
            found = self.words[here]
            hit = found == hashes[todo]
            out[todo[hit]] = self.numbers[here[hit]]
            todo = todo[found < hashes[todo]]
            at[todo] += 1
        return out


def survey(docs: DataFrame, window: int, group_suffixes: int, total: int) -> Survey:
    """Count prefixes and words.

    A cell of prefixes is heavy if it holds more suffixes of all texts than a quarter of a group.
    ``total`` is about the number of suffixes.  Counts are summed where the cells
    are; the driver gets a bit a cell.  Frequent words get short numbers for
    transport, that is all; they are looked for in the first ``WORD_BLOCKS`` blocks of
    each task and are ``RANGES * RANGE_WORDS`` at most (12 MB).
    """
    lengths, bits = [x for x in LENGTHS if x < window], cell_bits(total, group_suffixes)
    most = max(group_suffixes, total >> (bits - 6)) // 4
    ranges = 1 << (bits - CELL_BITS[0])
    wide = 1 << CELL_BITS[0]

    def row(length: int, part: int, data: bytes, n: bytes | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"length": pa.array([length], pa.int32()), "part": pa.array([part], pa.int32()), "data": pa.array([data], pa.binary()), "n": pa.array([n], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros((len(lengths), 1 << bits), dtype=np.int32), []
        for block in blocks(batches):
            found = words(block)
            hashes = word_hashes(block, found)
            if len(seen) < WORD_BLOCKS:
                seen.append(hashes)
            sums, (first, _) = prefix_sums(hashes), _starts(found, window)
            for k, length in enumerate(lengths):
                held[k] += np.bincount(_cells(sums, first, length, bits), minlength=1 << bits).astype(np.int32)
        known, n = np.unique(np.concatenate([np.zeros(0, dtype=U64), *seen]), return_counts=True)
        edge = np.searchsorted(known >> U64(32), np.arange(RANGES + 1, dtype=U64) * U64((1 << 32) // RANGES))
        for k in np.flatnonzero(np.diff(edge)).tolist():
            yield row(-1, k, packed.squeeze(known[edge[k] : edge[k + 1]]), packed.squeeze(n[edge[k] : edge[k + 1]]))
        for k in range(len(lengths)):
            for part in np.flatnonzero(held[k].reshape(ranges, wide).any(axis=1)).tolist():
                yield row(k, part, packed.squeeze(held[k, part * wide : (part + 1) * wide]))

    def merge(table: pa.Table) -> pa.Table:
        length, part = table.column("length")[0].as_py(), table.column("part")[0].as_py()
        if length < 0:
            known, at = np.unique(np.concatenate([packed.unsqueeze(x.as_py(), U64) for x in table.column("data")]), return_inverse=True)
            n = np.bincount(at, np.concatenate([packed.unsqueeze(x.as_py(), np.int64) for x in table.column("n")])).astype(np.int64)
            best = np.argsort(-n, kind="stable")[:RANGE_WORDS]
            return pa.Table.from_batches([row(length, part, known[best].tobytes(), n[best].tobytes())])
        total = sum(packed.unsqueeze(x.as_py(), np.int32).astype(np.int64) for x in table.column("data"))
        return pa.Table.from_batches([row(length, part, np.packbits(total > most).tobytes())])

    kind = "length int, part int, data binary, n binary"
    heavy = np.zeros((len(lengths), ranges, wide), dtype=bool)
    known, often = [np.zeros(0, dtype=U64)], [np.zeros(0, dtype=np.int64)]
    for told in docs.select("doc_id", "text").mapInArrow(count, kind).groupBy("length", "part").applyInArrow(merge, kind).toArrow().to_pylist():
        if told["length"] < 0:
            known.append(np.frombuffer(told["data"], dtype=U64))
            often.append(np.frombuffer(told["n"], dtype=np.int64))
        else:
            heavy[told["length"], told["part"]] = np.unpackbits(np.frombuffer(told["data"], dtype=np.uint8)).astype(bool)
    known, often = np.concatenate(known), np.concatenate(often)
    numbers = np.empty(len(known), dtype=np.int32)
    numbers[np.lexsort((known, -often))] = np.arange(len(known))
    order = np.argsort(known)
    return Survey(heavy.reshape(len(lengths), -1), known[order], numbers[order])


def groups_of(sums: np.ndarray, first: np.ndarray, window: int, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each suffix as a hash, and its prefix length: the shortest one whose cell isn't heavy, else ``window``."""
    chosen = mix(span_hashes(sums, first, first + window) ^ U64(0x5BD1E995))
    used = np.full(len(first), window, dtype=np.int64)
    bits = heavy.shape[1].bit_length() - 1
    open_ = np.arange(len(first))
    for k in range(len(heavy)):
        cell = _cells(sums, first[open_], LENGTHS[k], bits)
        light = ~heavy[k][cell]
        chosen[open_[light]] = mix((cell[light].astype(U64) << U64(8)) | U64(k + 1))
        used[open_[light]] = LENGTHS[k]
        open_ = open_[~light]
    return chosen, used


def sorted_suffixes(leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes (a row of word numbers each) and the lengths of common prefixes of neighbours in it."""
    n, depth = leaves.shape
    bits = max(1, int(leaves.max(initial=0)).bit_length())
    each = min(depth, 64 // bits)
    keys = []
    for low in range(0, depth, each):
        key = np.zeros(n, dtype=U64)
        for column in range(low, min(low + each, depth)):
            key = (key << U64(bits)) | leaves[:, column].astype(U64)
        keys.append(key)
    order = np.lexsort(keys[::-1])
    common = np.full(max(0, n - 1), depth, dtype=np.int64)
    for column in range(depth - 1, -1, -1):
        along = leaves[order, column]
        common[along[1:] != along[:-1]] = column
    return order, common


def deep_nodes(common: np.ndarray, depth: int) -> np.ndarray:
    """Where the leaves of each node of at least this depth begin among sorted suffixes; a lone leaf is one of its own."""
    return np.flatnonzero(np.concatenate(([True], common < depth)))


def later_than_least(docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of these doc_ids are above the least of their run."""
    return docs > np.repeat(np.minimum.reduceat(docs, starts), np.diff(starts, append=len(docs)))


def repeated(leaves: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The suffixes below a deep node that a smaller doc_id has a suffix below, too."""
    order, common = sorted_suffixes(leaves)
    return order[later_than_least(docs[order], deep_nodes(common, leaves.shape[1]))]


def settled(leaves: np.ndarray, whole: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which suffixes of a flush a smaller doc_id of the flush repeats.

    Leaves are brought together by the hash of their window and compared by words.
    Should two windows share a hash, some leaves are left to the subtree.
    """
    order = np.argsort(whole)
    new = np.ones(len(order), dtype=bool)
    same = np.flatnonzero(whole[order[1:]] == whole[order[:-1]])
    new[same + 1] = (leaves[order[same + 1]] != leaves[order[same]]).any(axis=1)
    out = np.zeros(len(order), dtype=bool)
    out[order] = later_than_least(docs[order], np.flatnonzero(new))
    return out


def in_company(docs: DataFrame, window: int, total: int, print_bits: int) -> DataFrame:
    """(row, n, at): for a row's key, how many of its suffixes have company, and lists of gaps between them (int32)."""
    n_parts = max(parts(docs.sparkSession, 1), total // (4 << 20))
    unused = U64(0xFFFFFFFF) ^ U64((1 << print_bits) - 1)
    shape = "part int, flush long, prints binary, leaf binary, rows binary, sizes binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows, counts, prints = (np.concatenate([x[k] for x in held]) for k in range(3))
            held.clear()
            name = int(mix(np.bitwise_xor.reduce(mix(rows.view(U64) + np.arange(len(rows), dtype=U64)), keepdims=True)).view(np.int64)[0])
            order = np.argsort(prints, kind="stable")
            starts = packed.run_starts(prints[order])
            n = np.diff(starts, append=len(order))
            among = np.sort(order[np.repeat(n > 1, n)]) + 1
            yield pa.RecordBatch.from_pydict({"part": pa.array([name % n_parts], pa.int32()), "flush": pa.array([name], pa.int64()), "prints": pa.array([None], pa.binary()), "leaf": [packed.pack_sorted(among.astype(np.uint32))], "rows": [rows.tobytes()], "sizes": [packed.squeeze(counts.astype(np.uint32))]})
            prints, leaf = prints[order[starts]], np.where(n > 1, 0, order[starts] + 1).astype(np.uint32)
            edge = packed.bounds(prints, n_parts)
            for k in np.flatnonzero(np.diff(edge)).tolist():
                own = slice(edge[k], edge[k + 1])
                yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "flush": pa.array([name], pa.int64()), "prints": [packed.pack_sorted((prints[own] & packed.LOW).astype(np.uint32))], "leaf": [packed.squeeze(leaf[own])], "rows": pa.array([None], pa.binary()), "sizes": pa.array([None], pa.binary())})

        for batch in batches:
            keys, done = batch.column(2).to_numpy(), 0
            for block in blocks(iter([batch])):
                found = words(block)
                sums, (first, counts) = prefix_sums(word_hashes(block, found)), _starts(found, window)
                own = keys[done : done + len(block)][counts > 0]
                held.append((own, counts[counts > 0], packed.place(span_hashes(sums, first, first + window), n_parts) & ~unused))
                done, size = done + len(block), size + len(first)
                if size >= FLUSH_PRINTS:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        told = table.filter(table.column("rows").is_valid()).select(["flush", "leaf", "rows", "sizes"])
        table = table.filter(table.column("rows").is_null())
        if not len(table):
            return told
        flushes = table.column("flush").to_numpy()
        prints = [packed.unpack_sorted(x.as_py()) for x in table.column("prints")]
        owner = np.repeat(np.arange(len(prints), dtype=np.int32), [len(x) for x in prints])
        prints, leaf = np.concatenate(prints), np.concatenate([packed.unsqueeze(x.as_py(), np.uint32) for x in table.column("leaf")])
        order = np.argsort(prints, kind="stable")
        starts = packed.run_starts(prints[order])
        n = np.diff(starts, append=len(order))
        company = (n > 1) | (np.minimum.reduceat(leaf[order], starts) == NO_LEAF)
        order = np.sort(order[np.repeat(company, n)])
        order = order[leaf[order] != NO_LEAF]
        owner, leaf = owner[order], leaf[order]
        order = np.lexsort((leaf, owner))
        edge = np.searchsorted(owner[order], np.arange(len(flushes) + 1))
        used = np.flatnonzero(np.diff(edge))
        lists = [packed.pack_sorted(leaf[order[edge[k] : edge[k + 1]]]) for k in used]
        none = pa.nulls(len(used), pa.binary())
        found = pa.table({"flush": flushes[used], "leaf": pa.array(lists, pa.binary()), "rows": none, "sizes": none})
        return pa.concat_tables([told.cast(found.schema), found])

    def resolve(table: pa.Table) -> pa.Table:
        told = table.filter(table.column("rows").is_valid())
        if not len(told):
            raise ValueError("a flush without its rows: texts changed between tries of a task")
        rows = np.frombuffer(told.column("rows")[0].as_py(), dtype=np.int64)
        ends = np.cumsum(packed.unsqueeze(told.column("sizes")[0].as_py(), np.uint32).astype(np.int64))
        leaf = np.unique(np.concatenate([packed.unpack_sorted(x.as_py()) for x in table.column("leaf")])).astype(np.int64) - 1
        edge = np.searchsorted(leaf, np.concatenate(([0], ends)))
        used = np.flatnonzero(np.diff(edge))
        lists = [np.diff(leaf[edge[k] : edge[k + 1]] - (ends[k - 1] if k else 0), prepend=0).astype(np.int32).tobytes() for k in used]
        return pa.table({"row": rows[used], "n": np.diff(edge)[used], "at": pa.array(lists, pa.binary())})

    kind = "flush long, leaf binary, rows binary, sizes binary"
    met = docs.select("doc_id", "text", "row").mapInArrow(send, shape).repartition(n_parts, "part").groupBy("part").applyInArrow(meet, kind)
    lists = met.repartition(n_parts, "flush").groupBy("flush").applyInArrow(resolve, "row long, n long, at binary")
    return lists.groupBy("row").agg(F.max("n").alias("n"), F.collect_set("at").alias("at"))


SHAPE = "part int, flush long, leaf binary, words binary, rare binary, ids binary, owner binary, rows binary"


def _tagged(**values: object) -> pa.RecordBatch:
    """One row of :data:`SHAPE`."""
    names = [x.split() for x in SHAPE.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([values.get(name)], kinds[kind]) for name, kind in names], names=[name for name, _ in names])


class Flush:
    """Suffixes with company of some blocks, with the words that they need."""

    def __init__(self, window: int, known: Survey):
        self.window, self.known = window, known
        self.hashes, self.first, self.group, self.whole, self.ids, self.rows, self.at = ([] for _ in range(7))
        self.words = self.suffixes = 0

    def add(self, block: Block, keys: np.ndarray, lists: list[np.ndarray]) -> None:
        found = words(block)
        counts = np.maximum(np.diff(found.first) - self.window + 1, 0)
        lists = [x[: np.searchsorted(x, n)] for x, n in zip(lists, counts.tolist(), strict=True)]
        sizes = [len(x) for x in lists]
        if not sum(sizes):
            return
        at = np.concatenate(lists)
        first = np.repeat(found.first[:-1], sizes) + at
        hashes = word_hashes(block, found)
        sums = prefix_sums(hashes)
        self.group.append(groups_of(sums, first, self.window, self.known.heavy)[0])
        self.whole.append(span_hashes(sums, first, first + self.window))
        self.ids.append(np.repeat(block.ids, sizes))
        self.rows.append(np.repeat(keys, sizes))
        self.at.append(at.astype(np.int32))
        self.first.append(first + self.words)
        self.hashes.append(hashes)
        self.words, self.suffixes = self.words + len(hashes), self.suffixes + len(at)

    def full(self) -> bool:
        return self.suffixes >= FLUSH_SUFFIXES or self.words >= FLUSH_WORDS

    def packed(self, n_parts: int) -> Iterator[pa.RecordBatch]:
        """The flush's rows of :data:`SHAPE`: what its leaves are and which of them it marks itself, then the others' words by part."""
        ids, rows, at, first, group, whole, hashes = map(np.concatenate, (self.ids, self.rows, self.at, self.first, self.group, self.whole, self.hashes))
        name = int(mix(np.bitwise_xor.reduce(mix(rows.view(U64) + at.astype(U64)), keepdims=True)).view(np.int64)[0])
        number = self.known.numbered(hashes)
        rare, number[number < 0] = number < 0, 0
        base = len(self.known.words)
        spelt, number[rare] = np.unique(hashes[rare], return_inverse=True)
        number[rare] += base
        leaves = number[first[:, None] + np.arange(self.window)]
        marked = settled(leaves, whole, ids)
        yield _tagged(part=name % n_parts, flush=name, leaf=packed.pack_sorted(np.flatnonzero(marked).astype(np.uint32)), ids=packed.squeeze(ids), rows=packed.squeeze(rows), owner=packed.squeeze(at))
        part = (((group >> U64(32)) * U64(n_parts)) >> U64(32)).astype(np.int64)
        left = np.flatnonzero(~marked)
        first, second = np.minimum(leaves[left, :2], (1 << 20) - 1).astype(U64).T
        lead = (part[left].astype(U64) << U64(40)) | (first << U64(20)) | second
        left = left[np.argsort(lead)]
        edge = np.searchsorted(part[left], np.arange(n_parts + 1))
        for k in np.flatnonzero(np.diff(edge)).tolist():
            own = left[edge[k] : edge[k + 1]]
            symbols = leaves[own].T.reshape(-1)
            unknown = symbols >= base
            used, symbols[unknown] = np.unique(symbols[unknown], return_inverse=True)
            symbols[unknown] += base
            docs, owner = np.unique(ids[own], return_inverse=True)
            yield _tagged(part=k, flush=name, leaf=packed.squeeze(own.astype(np.uint32)), words=packed.squeeze(symbols), rare=packed.squeeze(spelt[used - base]), ids=packed.squeeze(np.diff(docs, prepend=np.int64(0))), owner=packed.squeeze(owner.astype(np.int32)))


def repeat_marks(docs: DataFrame, company: DataFrame, window: int, group_suffixes: int, known: Survey, n_rows: int) -> DataFrame:
    """(doc_id, h, at): for a row, the ascending int32 indexes of the words where a window starts that a smaller doc_id has too."""
    spark = docs.sparkSession
    total = company.agg(F.sum("n")).first()[0] or 0
    n_parts = max(parts(spark, 1), total // group_suffixes)
    shared = spark.sparkContext.broadcast(known)
    base = len(known.words)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = Flush(window, shared.value)
        for batch in batches:
            keys, done = batch.column(2).to_numpy(), 0
            lists = [np.unique(np.concatenate([np.cumsum(np.frombuffer(x, dtype=np.int32), dtype=np.int64) for x in row])) for row in batch.column(3).to_pylist()]
            for block in blocks(iter([batch])):
                flush.add(block, keys[done : done + len(block)], lists[done : done + len(block)])
                done += len(block)
                if flush.full():
                    yield from flush.packed(n_parts)
                    flush = Flush(window, shared.value)
        if flush.suffixes:
            yield from flush.packed(n_parts)

    def subtree(table: pa.Table) -> pa.Table:
        told = table.filter(table.column("words").is_null()).select(["flush", "leaf", "ids", "rows", "owner"])
        table = table.filter(table.column("words").is_valid())
        if not len(table):
            return told
        rare = [packed.unsqueeze(x.as_py(), U64) for x in table.column("rare")]
        spelt = np.unique(np.concatenate(rare))
        leaves, docs = [], []
        for own, x, ids, owner in zip(rare, *(table.column(c) for c in ("words", "ids", "owner")), strict=True):
            symbols = packed.unsqueeze(x.as_py(), np.int32)
            unknown = symbols >= base
            symbols[unknown] = base + np.searchsorted(spelt, own)[symbols[unknown] - base]
            leaves.append(symbols.reshape(window, -1).T)
            docs.append(np.cumsum(packed.unsqueeze(ids.as_py(), np.int64))[packed.unsqueeze(owner.as_py(), np.int32)])
        leaf = [packed.unsqueeze(x.as_py(), np.uint32) for x in table.column("leaf")]
        flush = np.repeat(np.arange(len(leaf)), [len(x) for x in leaf])
        leaves, docs = np.concatenate(leaves), np.concatenate(docs)
        marked = repeated(leaves, docs)
        leaf, flush = np.concatenate(leaf)[marked], flush[marked]
        order = np.lexsort((leaf, flush))
        edge = np.searchsorted(flush[order], np.arange(len(table) + 1))
        used = np.flatnonzero(np.diff(edge))
        none = pa.nulls(len(used), pa.binary())
        lists = pa.array([packed.pack_sorted(leaf[order[edge[k] : edge[k + 1]]]) for k in used.tolist()], pa.binary())
        return pa.concat_tables([told, pa.table({"flush": table.column("flush").to_numpy()[used], "leaf": lists, "ids": none, "rows": none, "owner": none}).cast(told.schema)])

    def resolve(table: pa.Table) -> pa.Table:
        told = table.filter(table.column("rows").is_valid())
        if not len(told):
            raise ValueError("a flush without its rows: texts changed between tries of a task")
        leaf = np.unique(np.concatenate([packed.unpack_sorted(x.as_py()) for x in table.column("leaf")]))
        ids, rows, at = (packed.unsqueeze(told.column(c)[0].as_py(), kind)[leaf] for c, kind in (("ids", np.int64), ("rows", np.int64), ("owner", np.int32)))
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1]) | (at[1:] <= at[:-1])
        edge = np.append(np.flatnonzero(new), len(rows))
        return pa.table({"doc_id": ids[edge[:-1]], "h": rows[edge[:-1]], "at": pa.array([at[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())})

    texts = touched(docs, bitmaps.collect_bitmap(company, F.col("row")), True).repartition(n_rows, "row")
    sent = texts.join(company, "row").select("doc_id", "text", "h", "at").mapInArrow(send, SHAPE)
    trees = sent.repartition(n_parts, "part").groupBy("part").applyInArrow(subtree, "flush long, leaf binary, ids binary, rows binary, owner binary")
    return trees.repartition(n_parts, "flush").groupBy("flush").applyInArrow(resolve, "doc_id long, h long, at binary").groupBy("doc_id", "h").agg(F.collect_set("at").alias("at"))


def touched(docs: DataFrame, bitmap: np.ndarray, wanted: bool) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, h, row) whose ``row`` the bitmap may hold, or surely doesn't."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select([0, 1, 2, 3]).filter(pa.array(bitmaps.test(shared.value, batch.column(4).to_numpy().view(U64)) == wanted))

    return docs.withColumn("place", F.xxhash64("row")).mapInArrow(run, "doc_id long, text string, h long, row long")


def remove_repeats(docs: DataFrame, window: int = 13, group_suffixes: int = 1 << 18, print_bits: int = 32) -> DataFrame:
    """(doc_id, text, n_words, removed) for each row of ``docs`` (doc_id bigint, text string).

    Words are runs of bytes other than ``\\x20 \\x09-\\x0D``, unchanged.  A word goes
    if it is covered by ``window`` consecutive words of its text that also start
    in a text with a smaller doc_id; all windows are judged on the input.
    ``text`` is the kept words joined by one space, ``n_words`` the words before
    removal, ``removed`` the maximal removed spans as an array of (start, end) in
    words, end exclusive.  Null and blank texts give an empty text and no words.
    Rows that repeat a doc_id are one document to each other: neither removes
    from the other.  Rows with a null doc_id are kept whole and remove nothing.
    Other columns are ignored; an empty table gives an empty result.

    ``group_suffixes`` is the size of a group in suffixes; ``print_bits`` (32 at
    most) the length of fingerprints within a part, which doesn't change results.
    """
    if window < 2:
        raise ValueError("window must be 2 words at least")
    bounded_batches(docs.sparkSession)
    free_finished(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", F.xxhash64("text")).withColumn("row", F.xxhash64("doc_id", "h"))
    named = docs.where("doc_id is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    total, n_rows = size // 6, max(parts(docs.sparkSession, 1), size // TASK_BYTES)
    known = survey(named, window, group_suffixes, total)
    company = durable(in_company(named, window, total, print_bits))
    marks = durable(repeat_marks(named, company, window, group_suffixes, known, n_rows))
    hit = bitmaps.collect_bitmap(marks.select(F.xxhash64("doc_id", "h").alias("row")), F.col("row"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_parts(batch.column(1))
            raw, kept, counts, spans = data.tobytes(), [], [], []
            for low, high, at in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column(2).to_pylist(), strict=True):
                found = raw[low:high].split()
                counts.append(len(found))
                if at is None:
                    spans.append([])
                else:
                    at = np.unique(np.frombuffer(b"".join(at), dtype=np.int32))
                    change = np.bincount(at, minlength=len(found) + 1) - np.bincount(at + window, minlength=len(found) + 1)
                    gone = np.cumsum(change[: len(found)]) > 0
                    turn = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
                    spans.append([{"start": a, "end": b} for a, b in zip(turn[::2], turn[1::2], strict=True)])
                    found = compress(found, (~gone).tolist())
                kept.append(b" ".join(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["doc_id", "text", "n_words", "removed"])

    kind = "doc_id long, text string, n_words long, removed array<struct<start:int,end:int>>"
    whole = touched(docs, hit, False).select("doc_id", "text", F.lit(None).cast("array<binary>").alias("at"))
    rest = touched(docs, hit, True).repartition(n_rows, "doc_id", "h").join(marks, ["doc_id", "h"], "left").select("doc_id", "text", "at")
    return whole.mapInArrow(finish, kind).unionByName(rest.mapInArrow(finish, kind))
