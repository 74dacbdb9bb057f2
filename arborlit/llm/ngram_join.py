"""N-gram Jaccard join by token-combination prefixes.

Each text is the set of its distinct word shingles.  Sets of size n can link
only with an overlap of at least ceil(p * n / 100), so at most
tau = n - ceil(p * n / 100) of a set's tokens are missing from a partner.

Tokens are ordered by class, rare before frequent, then by hash.  A token is
frequent if it occurs in at least ``frequent_df`` texts, counted over the whole
corpus; the class is read from a bitmap of fixed size, so that a collision makes
a token frequent for every text alike and costs time only.  A set indexes the
shortest prefix that still shares a signature with any partner after losing tau
tokens: a rare token is a signature by itself, frequent tokens of one hash class
sign in pairs, so a class of s tokens outlives s - 1 losses and the prefix is
extended until rare tokens plus the sum of (s - 1) exceed tau.  The number of
classes follows the set's size in powers of two, and a set indexes every level
that a partner's size may have.

Sets that share a signature are compared in two rounds.  First each with a
centre of its posting list, the set whose lists are the longest altogether; the
verified links are contracted.  Then all pairs whose ends still lie in different
components.  A pair left out is connected already, so components are exact and no
near-copy group is expanded into all of its pairs.  Equal sets are one node from
the start.

A pair is first held against parity bitmaps of about one bit a token, whose
distance is a lower bound of the symmetric difference; only pairs that pass it
are verified on the tokens themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.llm import bitmaps, packed
from arborlit.llm.components import components
from arborlit.llm.session import bounded_batches, durable, parts
from arborlit.llm.textblocks import U64, blocks, mix, shingle_sets

FLUSH_TOKENS = 1 << 19
BLOCK_BYTES = 1 << 18  # hashing takes some ten arrays of eight bytes for each byte of a block
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
TILE = 2048


def needed(n: int, percent: int) -> int:
    """The least overlap with any partner of a set of ``n`` tokens."""
    return -(-percent * n // 100)


def set_id(tokens: np.ndarray) -> int:
    """A hash of a whole set, as a signed long."""
    return int(mix(np.array([np.sum(mix(tokens ^ U64(0xA5A5A5A55A5A5A5A))), len(tokens)], dtype=U64)).sum().astype(np.int64))


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of how many tokens fall into each of 2**k cells, at least as many as there are tokens."""
    bits = max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    return np.packbits(np.bincount((tokens & U64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def distance(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sketched sets."""
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(np.frombuffer(v, dtype=np.uint8).reshape(-1, size)) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def class_counts(n: int, percent: int) -> list[int]:
    """How many hash classes frequent tokens are dealt into: each power of two that a partner of a set of ``n`` may use."""
    level = lambda m: 1 << max(0, (m // 16).bit_length() - 1)
    low, high, out = level(needed(n, percent)), level(100 * n // percent), []
    while low <= high:
        out.append(low)
        low *= 2
    return out


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of one set; ``tokens`` ascending, ``frequent`` their classes."""
    n = len(tokens)
    if n < 2:
        return np.zeros(0, dtype=U64)  # only an equal set could link
    lost = n - needed(n, percent)
    rare = tokens[~frequent]
    if len(rare) > lost:
        return rare[: lost + 1]
    common, found = tokens[frequent], [rare]
    for classes in class_counts(n, percent):
        group = (common & U64(classes - 1)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        first = np.zeros(len(common), dtype=bool)
        first[order[packed.run_starts(group[order])]] = True
        held = len(rare) + np.cumsum(~first)
        end = min(int(np.searchsorted(held, lost + 1)) + 1, len(common))
        prefix, group = common[:end], group[:end]
        order = np.argsort(group, kind="stable")
        prefix, group = prefix[order], group[order]
        for step in range(1, len(prefix)):
            together = group[step:] == group[:-step]
            if not together.any():
                break
            pair = prefix[:-step][together] * U64(0x9FB21C651E98DF25) + mix(prefix[step:][together] + U64(classes))
            found.append(mix(pair))
    return np.unique(np.concatenate(found))


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray]]:
    for block in blocks(batches, size=BLOCK_BYTES):
        yield from zip(block.ids.tolist(), shingle_sets(block, width), strict=True)


def _frequent(docs: DataFrame, width: int, least: int) -> np.ndarray:
    """A bitmap of the tokens that at least ``least`` texts hold (copies within a block of texts count once)."""
    n_parts = parts(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, size = [], set(), 0

        def flush() -> pa.RecordBatch:
            keys = np.sort(packed.place(np.concatenate(held), n_parts))
            edge = packed.bounds(keys, n_parts)
            full = np.flatnonzero(np.diff(edge))
            rows = [packed.pack_sorted((keys[edge[k] : edge[k + 1]] & packed.LOW).astype(np.uint32)) for k in full]
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(rows, pa.binary())], names=["part", "data"])

        for _, tokens in _sets(batches, width):
            if len(tokens) and (key := set_id(tokens)) not in seen:
                seen.add(key)
                held.append(tokens)
                size += len(tokens)
            if size >= FLUSH_TOKENS:
                yield flush()
                held, seen, size = [], set(), 0
        if held:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys = np.sort(np.concatenate([packed.unpack_sorted(x.as_py()) for x in table.column("data")]))
        starts = packed.run_starts(keys)
        many = keys[starts[np.diff(starts, append=len(keys)) >= least]]
        place = np.sort(mix((U64(part) << U64(32)) | many.astype(U64)) >> U64(64 - bitmaps.BITS))
        word = place >> U64(6)
        at = packed.run_starts(word)
        bits = np.bitwise_or.reduceat(U64(1) << (place & U64(63)), at) if len(at) else np.zeros(0, dtype=U64)
        return pa.table({"w": word[at].astype(np.int64), "b": bits.view(np.int64)})

    counted = docs.select("doc_id", "text").mapInArrow(send, "part int, data binary").groupBy("part").applyInArrow(count, "w long, b long")
    merged = counted.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bitmaps.BITS - 6), dtype=U64)
    out[merged.column("w").to_numpy()] = merged.column("b").to_numpy().view(U64)
    return out


def _postings(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(sig, set_id, n, size): each set of a posting list that has a partner of fitting size there, and the size of the list."""
    n_parts = parts(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, sizes, seen, size = [], [], [], set(), 0

        def flush() -> pa.RecordBatch:
            keys = packed.place(np.concatenate(held), n_parts)
            reps = [len(x) for x in held]
            order = np.argsort(keys, kind="stable")
            keys, owner, n = keys[order], np.repeat(np.array(ids, dtype=np.int64), reps)[order], np.repeat(np.array(sizes, dtype=np.int32), reps)[order]
            edge = packed.bounds(keys, n_parts)
            full = np.flatnonzero(np.diff(edge))
            cut = [slice(edge[k], edge[k + 1]) for k in full]
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([packed.pack_sorted((keys[s] & packed.LOW).astype(np.uint32)) for s in cut], pa.binary()), pa.array([owner[s].tobytes() for s in cut], pa.binary()), pa.array([packed.squeeze(n[s]) for s in cut], pa.binary())], names=["part", "sig", "owner", "n"])

        for _, tokens in _sets(batches, width):
            if len(tokens) < 2 or (key := set_id(tokens)) in seen:
                continue
            seen.add(key)
            found = signatures(tokens, bitmaps.test(shared.value, mix(packed.place(tokens, n_parts))), percent)
            held.append(found)
            ids.append(key)
            sizes.append(len(tokens))
            size += len(found)
            if size >= FLUSH_TOKENS:
                yield flush()
                held, ids, sizes, seen, size = [], [], [], set(), 0
        if held:
            yield flush()

    def gather(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        sig = np.concatenate([packed.unpack_sorted(x.as_py()) for x in table.column("sig")])
        order = np.argsort(sig, kind="stable")
        alone = np.ones(len(sig), dtype=bool)
        ordered = sig[order]
        same = ordered[1:] == ordered[:-1]
        alone[1:][same] = False
        alone[:-1][same] = False
        order = order[~alone]
        sig = sig[order]
        owner = np.concatenate([np.frombuffer(x.as_py(), dtype=np.int64) for x in table.column("owner")])[order]
        n = np.concatenate([packed.unsqueeze(x.as_py(), np.int32) for x in table.column("n")])[order].astype(np.int64)
        order = np.lexsort((owner, n, sig))
        sig, owner, n = sig[order], owner[order], n[order]
        keep = np.ones(len(sig), dtype=bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1]) | (n[1:] != n[:-1])
        sig, owner, n = sig[keep], owner[keep], n[keep]
        near = (sig[1:] == sig[:-1]) & (percent * n[1:] <= 100 * n[:-1])
        keep = np.zeros(len(sig), dtype=bool)
        keep[1:] |= near
        keep[:-1] |= near
        sig, owner, n = sig[keep], owner[keep], n[keep]
        starts = packed.run_starts(sig)
        size = np.diff(starts, append=len(sig))
        return pa.table({"sig": ((U64(part) << U64(32)) | sig.astype(U64)).view(np.int64), "set_id": owner, "n": n.astype(np.int32), "size": np.repeat(size, size)})

    sent = docs.select("doc_id", "text").mapInArrow(send, "part int, sig binary, owner binary, n binary")
    out = durable(sent.groupBy("part").applyInArrow(gather, "sig long, set_id long, n int, size long"))
    shared.destroy()
    return out


def _members(postings: DataFrame) -> DataFrame:
    """(c, set_id): for each set that is the centre of a posting list, the sets of its lists, itself among them."""
    weight = postings.groupBy("set_id").agg(F.sum("size").alias("weight"))
    centre = postings.join(weight, "set_id").groupBy("sig").agg(F.max(F.struct("weight", "set_id")).alias("c"))
    return postings.select("sig", "set_id").join(centre.select("sig", F.col("c.set_id").alias("c")), "sig").select("c", "set_id").distinct()


def _near(reps: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches don't rule out a link."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, sa, sb = (batch.column(k).to_pylist() for k in (2, 3, 4, 5))
            near = [(100 + percent) * (m + n - distance(x, y)) >= 2 * percent * (m + n) for m, n, x, y in zip(na, nb, sa, sb, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    held = reps.select("set_id", "n", "sketch")
    joined = pairs.join(held.toDF("a", "na", "sa"), "a").join(held.toDF("b", "nb", "sb"), "b").where((100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na")))
    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(keep, "a long, b long")


def _across(members: DataFrame, reps: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) below one centre, in different components, whose sketches don't rule out a link.

    A centre's members are dealt into tiles of about ``TILE`` sets, and a task
    compares two tiles at a time, so no task holds all of a centre's members and
    no pair that fails leaves its task.
    """
    n_parts = parts(members.sparkSession)
    labelled = members.join(near, "set_id", "left").select("c", "set_id", F.coalesce("comp", "set_id").alias("comp"))
    split = labelled.groupBy("c").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).where("low <> high").select("c", "tiles")
    tiled = labelled.join(split, "c").withColumn("tile", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
    tiled = tiled.join(reps.select("set_id", "n", "sketch"), "set_id").select(F.pmod(F.xxhash64("c", "i", "j"), F.lit(n_parts)).cast("int").alias("part"), "c", "i", "j", "tile", "set_id", "comp", "n", "sketch")

    def compare(table: pa.Table) -> pa.Table:
        c, i, j, tile, ids, comp, n = (table.column(k).to_numpy() for k in ("c", "i", "j", "tile", "set_id", "comp", "n"))
        sketches = np.array(table.column("sketch").to_pylist(), dtype=object)
        order = np.lexsort((n, j, i, c))
        change = (np.diff(c[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)
        left, right = [], []
        for at in np.split(order, np.flatnonzero(change) + 1):
            if comp[at].min() == comp[at].max():
                continue
            size = np.array([len(x) for x in sketches[at]])
            for level in np.unique(size):
                low, both = at[size == level], at[(size == level) | (size == 2 * level)]
                bits = np.array([np.bitwise_xor.reduce(np.frombuffer(x, dtype=U64).reshape(-1, level // 8)) for x in sketches[both]])
                for k, x in enumerate(low):
                    y = np.arange(k + 1, len(both))  # sizes ascend with n, so ``low`` comes first
                    rest = both[y]
                    fit = (comp[rest] != comp[x]) & (percent * n[rest] <= 100 * n[x]) & (percent * n[x] <= 100 * n[rest])
                    if i[x] != j[x]:
                        fit &= tile[rest] != tile[x]
                    y, rest = y[fit], rest[fit]
                    if not len(rest):
                        continue
                    own = np.bitwise_xor.reduce(np.frombuffer(sketches[x], dtype=U64).reshape(-1, level // 8))
                    apart = np.bitwise_count(bits[y] ^ own).sum(axis=1, dtype=np.int64)
                    total = n[x] + n[rest]
                    keep = rest[(100 + percent) * (total - apart) >= 2 * percent * total]
                    left.append(np.full(len(keep), ids[x]))
                    right.append(ids[keep])
        left, right = (np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for v in (left, right))
        return pa.table({"a": np.minimum(left, right), "b": np.maximum(left, right)})

    return tiled.groupBy("part").applyInArrow(compare, "a long, b long").distinct()


def _tokens(docs: DataFrame, reps: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set_id, tokens): the tokens of the wanted sets, one row each, made anew from their texts.

    A bitmap of the ids that stand for them lets few other texts through; what is
    kept is decided by the set's own id.
    """
    chosen = durable(reps.join(wanted, "set_id").select("set_id", "rep"))
    asked = docs.sparkSession.sparkContext.broadcast(bitmaps.collect_bitmap(chosen, F.col("rep")))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bitmaps.test(asked.value, batch.column(2).to_numpy().view(U64))))
            found = [x for _, x in _sets(iter([batch]), width) if len(x)]
            for low in range(0, len(found), 512):
                part = found[low : low + 512]
                yield pa.RecordBatch.from_arrays([pa.array([set_id(x) for x in part], pa.int64()), pa.array([x.tobytes() for x in part], pa.binary())], names=["set_id", "tokens"])

    made = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).where("doc_id is not null").mapInArrow(make, "set_id long, tokens binary")
    out = durable(made.join(chosen.select("set_id"), "set_id", "left_semi").dropDuplicates(["set_id"]))
    asked.destroy()
    return out


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of set ids whose sets link."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=U64), np.frombuffer(y.as_buffer(), dtype=U64)
                both = np.sort(np.concatenate((x, y)), kind="stable")
                same = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    made = _tokens(docs, reps, pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), width)
    joined = pairs.join(made.toDF("a", "ta"), "a").join(made.toDF("b", "tb"), "b")
    return joined.select("a", "b", "ta", "tb").mapInArrow(links, "a long, b long")


@dataclass(frozen=True)
class Joined:
    """The join's state: every row's set, a doc_id for each set, and links between sets that connect all that link."""

    docs: DataFrame
    sets: DataFrame
    reps: DataFrame
    links: DataFrame


def _join(docs: DataFrame, width: int, percent: int, frequent_df: int) -> Joined:
    if not 60 <= percent <= 100:
        raise ValueError("percent must be from 60 to 100")
    bounded_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, sketches = [], [], []
            for _, tokens in _sets(iter([batch]), width):
                n.append(len(tokens))
                ids.append(set_id(tokens) if len(tokens) else None)
                sketches.append(sketch(tokens) if len(tokens) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.array(sketches, pa.binary())], names=["doc_id", "n", "set_id", "sketch"])

    sets = durable(docs.mapInArrow(describe, "doc_id long, n long, set_id long, sketch binary"))
    named = sets.where("set_id is not null and doc_id is not null")
    reps = named.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min(F.struct("n", "sketch")).alias("s")).select("set_id", "rep", "s.n", "s.sketch")
    numbered = docs.where("doc_id is not null")
    postings = _postings(numbered, width, percent, _frequent(numbered, width, frequent_df))
    members = durable(_members(postings))
    first = members.where("c <> set_id").select(F.least("c", "set_id").alias("a"), F.greatest("c", "set_id").alias("b")).distinct()
    links = durable(_verified(numbered, reps, durable(_near(reps, first, percent)), width, percent))
    second = durable(_across(members, reps, components(links).toDF("set_id", "comp"), percent))
    if not second.isEmpty():
        links = links.unionAll(_verified(numbered, reps, second, width, percent))
    return Joined(numbered, sets, reps, links)


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 75, frequent_df: int = 48) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id bigint, text string).

    Words are runs of bytes other than ``\\x20 \\x09-\\x0D`` after lower-casing A-Z;
    ``n_shingles`` counts distinct ``width``-word shingles (the whole sequence, if
    the text has fewer words).  Two rows link when 100 * overlap >= ``percent`` *
    union; ``component_id`` is the smallest doc_id that links reach.  Null, empty
    and blank texts have no shingle and link with nothing, so each is its own
    component; a null doc_id keeps its row, counts its shingles and is its own
    component (null).  Rows that repeat a doc_id come out once each, with that
    doc_id's component; other columns are ignored.  ``percent`` is 60 to 100.
    An empty table gives an empty result.
    """
    found = _join(docs, width, percent, frequent_df)
    reps = found.reps.select("set_id", "rep")
    # the same text under several ids, and one id with several texts, also connect
    ids = found.sets.where("set_id is not null and doc_id is not null").join(reps, "set_id")
    by_text = ids.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    by_link = found.links.join(reps.toDF("a", "ra"), "a").join(reps.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    joined = components(by_text.unionAll(by_link)).toDF("doc_id", "component_id")
    return found.sets.join(joined, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def link_counts(docs: DataFrame, width: int = 5, percent: int = 75, frequent_df: int = 48) -> DataFrame:
    """(doc_id, n_shingles, n_links) for each row of ``docs``: how many other rows it links with.

    Links lie within components, so every set of a component is held against all
    others of it, in pairs of tiles of about ``TILE`` sets; a tile pair counts
    shared tokens by postings and gives a number for each set, never the pairs.
    The work is the square of a component's different sets, which is why
    :func:`jaccard_components` does without.  Rows, nulls and repeats are as
    there; rows with a null doc_id have no links and count for none.
    """
    found = _join(docs, width, percent, frequent_df)
    n_parts = parts(docs.sparkSession)
    weight = found.sets.where("set_id is not null and doc_id is not null").groupBy("set_id").agg(F.count("*").alias("weight"))
    near = durable(components(found.links).toDF("set_id", "comp"))
    tokens = _tokens(found.docs, found.reps, near.select("set_id"), width)
    tiles = near.groupBy("comp").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    rows = near.join(tiles, "comp").withColumn("tile", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
    rows = rows.join(tokens, "set_id").join(weight, "set_id").select(F.pmod(F.xxhash64("comp", "i", "j"), F.lit(n_parts)).cast("int").alias("part"), "comp", "i", "j", "tile", "set_id", "weight", "tokens")

    def count(table: pa.Table) -> pa.Table:
        comp, i, j, tile, ids, own = (table.column(k).to_numpy() for k in ("comp", "i", "j", "tile", "set_id", "weight"))
        held = [np.frombuffer(x, dtype=U64) for x in table.column("tokens").to_pylist()]
        size = np.array([len(x) for x in held])
        order, total = np.lexsort((j, i, comp)), np.zeros(len(ids), dtype=np.int64)
        change = (np.diff(comp[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)
        for at in np.split(order, np.flatnonzero(change) + 1):
            flat, owner = np.concatenate([held[k] for k in at]), np.repeat(np.arange(len(at)), size[at])
            _, token, many = np.unique(flat, return_inverse=True, return_counts=True)
            posting, first = owner[np.argsort(token, kind="stable")], np.cumsum(many) - many
            edge = np.concatenate(([0], np.cumsum(size[at])))
            for k, row in enumerate(at):
                mine = token[edge[k] : edge[k + 1]]
                reach = np.repeat(first[mine] - np.cumsum(many[mine]) + many[mine], many[mine]) + np.arange(many[mine].sum())
                same = np.bincount(posting[reach], minlength=len(at))
                linked = 100 * same >= percent * (size[row] + size[at] - same)
                linked &= tile[at] != tile[row] if i[row] != j[row] else np.arange(len(at)) != k
                total[row] = own[at][linked].sum()
        return pa.table({"set_id": ids, "links": total})

    links = rows.groupBy("part").applyInArrow(count, "set_id long, links long").groupBy("set_id").agg(F.sum("links").alias("links"))
    each = weight.join(links, "set_id", "left").select("set_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    counted = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0)))
    return found.sets.join(each, "set_id", "left").select("doc_id", F.col("n").alias("n_shingles"), counted.cast("long").alias("n_links"))
