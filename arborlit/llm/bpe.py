"""Byte-level BPE encoding and decoding with a given rank file.

Texts are split by a pattern; each distinct piece that a task hasn't met yet is
encoded once.  Such pieces are laid out, by length, as padded integer matrices
with a piece a row.  In each round every row merges its leftmost pair of minimum
rank: pairs find their rank in a hash table held in two arrays, the merged pair's
right half is taken out of the row, and rows that have no pair left are taken out
of the matrix.  A round costs the whole row, so pieces of more than ``LONG_PIECE``
bytes, a row each, make all merges of the minimum rank that can't interact in a
round, over a linked list instead of a compacted row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.llm.packed import run_starts
from arborlit.llm.session import bounded_batches
from arborlit.llm.textblocks import U64, mix, text_parts

NONE = np.int32(np.iinfo(np.int32).max)
CACHE_BYTES = 32 << 20
ENTRY_BYTES = 200  # of the dictionary and its objects, for each piece
MATRIX_CELLS = 1 << 17
LONG_PIECE = 1024


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a rank file: base64 token, space, rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class PairTable:
    """Open-addressing hash table from two adjacent token ids to the id of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = self.key(np.array(left, dtype=np.int64), np.array(right, dtype=np.int64))
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, U64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        todo, slot = np.arange(len(keys)), self.slot(keys)
        values = np.array(merged, dtype=np.int32)
        while len(todo):  # of those that want a free slot, one gets it; the rest go on
            free = self.values[slot] == NONE
            at, who = np.unique(slot[free], return_index=True)
            who = todo[free][who]
            self.keys[at], self.values[at] = keys[who], values[who]
            rest = ~np.isin(todo, who)
            todo, slot = todo[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(U64) << U64(32)) | right.astype(U64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, ``NONE`` where a pair doesn't merge or holds padding (-1)."""
        out = np.full(left.shape, NONE, dtype=np.int32)
        at = np.nonzero((left >= 0) & (right >= 0))
        keys = self.key(left[at], right[at])
        slot, found, todo = self.slot(keys), np.full(len(keys), NONE, dtype=np.int32), np.arange(len(keys))
        while len(todo):
            here = self.keys[slot]
            hit = here == keys[todo]
            found[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (self.values[slot] != NONE)
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        out[at] = found
        return out


class Encoder:
    """Encodes pieces by ranks; keeps what it has encoded up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.pairs = PairTable(ranks)
        self.bytes = np.array([ranks[bytes([k])] for k in range(256)], dtype=np.int32)
        self.known: dict[str, bytes] = {}
        self.held = 0  # about how many bytes ``known`` takes

    def _merge(self, pieces: list[bytes]) -> Iterator[bytes]:
        """The ids of pieces of similar length, as little-endian 32-bit integers."""
        size = np.array([len(x) for x in pieces])
        width = int(size.max())
        grid = np.full((len(pieces), width), -1, dtype=np.int32)
        grid[np.arange(width) < size[:, None]] = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        done: list[bytes] = [b""] * len(pieces)
        row = np.arange(len(pieces))
        rank = self.pairs.find(grid[:, :-1], grid[:, 1:])
        while len(row):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), dtype=np.int64)
            least = rank[np.arange(len(row)), best] if rank.shape[1] else np.full(len(row), NONE)
            over = least == NONE
            for k in np.flatnonzero(over):
                ids = grid[k]
                done[row[k]] = ids[ids >= 0].astype("<u4").tobytes()
            grid, rank, row, best, least = grid[~over], rank[~over], row[~over], best[~over], least[~over]
            if not len(row):
                break
            own, at = np.arange(len(row)), np.arange(grid.shape[1] - 1)
            grid[own, best] = least
            grid = np.take_along_axis(grid, at + (at > best[:, None]), axis=1)  # without the right half
            at = at[:-1]
            rank = np.take_along_axis(rank, at + (at >= best[:, None]), axis=1)
            for shift in (0, -1):  # the merged token's new pairs
                place = best + shift
                rows = np.flatnonzero((place >= 0) & (place < rank.shape[1]))
                rank[rows, place[rows]] = self.pairs.find(grid[rows, place[rows]], grid[rows, place[rows] + 1])
            used = int((grid >= 0).sum(axis=1).max())
            grid, rank = grid[:, :used], rank[:, : max(0, used - 1)]
        yield from done

    def _merge_long(self, piece: bytes) -> bytes:
        """The ids of one long piece, merged rank by rank over a linked list; near-linear in its length.

        Places wait in a bucket for their pair's rank, and a round takes the lowest rank's
        bucket: all its leftmost non-overlapping places that don't touch each other.  If a merged
        token would make a pair of lower rank with a neighbour, the leftmost place
        goes alone, as then the others' turn comes later.
        """
        token = self.bytes[np.frombuffer(piece, dtype=np.uint8)].astype(np.int64)
        n = len(token)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, NONE, dtype=np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        turns: list[int] = []

        def put(places: np.ndarray) -> None:
            places = places[rank[places] != NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            starts = run_starts(rank[places])
            for r, own in zip(rank[places[starts]].tolist(), np.split(places, starts[1:]), strict=False):
                if r not in waiting:
                    waiting[r] = []
                    heappush(turns, r)
                waiting[r].append(own)

        def ranked(places: np.ndarray) -> np.ndarray:
            """What the pairs that begin here merge to."""
            return self._pair(token[places], np.where(after[places] < n, token[np.minimum(after[places], n - 1)], -1))

        rank[:-1] = self.pairs.find(token[:-1], token[1:])
        put(np.arange(n - 1))
        while turns:
            r = heappop(turns)
            every = np.unique(np.concatenate(waiting.pop(r)))
            every = places = every[(token[every] >= 0) & (rank[every] == r)]
            if not len(places):
                continue
            overlaps = np.concatenate(([False], after[places[:-1]] == places[1:]))
            first = np.maximum.accumulate(np.where(overlaps, 0, np.arange(len(places))))
            places = places[(np.arange(len(places)) - first) % 2 == 0]
            ends = after[after[places]]
            touches = np.concatenate(([False], ends[:-1] == places[1:]))
            a, b = token[places[0]], token[after[places[0]]]
            chosen = places
            if touches.any():
                inner = self._pair(np.array([r, r, b]), np.array([r, a, r]))
                first = np.maximum.accumulate(np.where(touches, 0, np.arange(len(places))))
                chosen = places[(np.arange(len(places)) - first) % 2 == 0] if (inner >= r).all() else places[:1]
            while True:
                left, right = before[chosen], after[after[chosen]]
                merged = np.full(len(chosen), r)
                new_left = self._pair(np.where(left >= 0, token[left], -1), merged)
                new_right = self._pair(merged, np.where(right < n, token[np.minimum(right, n - 1)], -1))
                if len(chosen) == 1 or min(new_left.min(), new_right.min()) >= r:
                    break
                chosen = places[:1]
            token[after[chosen]] = -1
            token[chosen] = r
            after[chosen] = right
            inside = right < n
            before[right[inside]] = chosen[inside]
            inside = left >= 0
            rank[chosen] = new_right
            rank[left[inside]] = new_left[inside]
            again = np.concatenate((chosen, left[inside]))
            rank[again] = ranked(again)  # a place between two merges has both sides new
            put(again)
            put(every[(token[every] >= 0) & (rank[every] == r)])  # those that overlapped one that didn't go, too
        return token[token >= 0].astype("<u4").tobytes()

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.find(left, right).astype(np.int64)

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Encode pieces that aren't known yet; long ones are returned, not kept."""
        new: list[tuple[int, str, bytes]] = []
        long: dict[str, bytes] = {}
        for piece in pieces:
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self.keep(piece, whole.to_bytes(4, "little"))
            elif len(data) > LONG_PIECE:
                long[piece] = self._merge_long(data)
            else:
                new.append((len(data), piece, data))
        new.sort(key=lambda x: x[0])
        low = 0
        while low < len(new):
            high = low + 1
            while high < len(new) and new[high][0] <= 2 * new[low][0] and (high - low + 1) * new[high][0] <= MATRIX_CELLS:
                high += 1
            for (_, piece, _), ids in zip(new[low:high], self._merge([x[2] for x in new[low:high]]), strict=True):
                self.keep(piece, ids)
            low = high
        return long

    def keep(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.held += ENTRY_BYTES + 2 * len(piece) + len(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        pieces = [self.split(text) for text in texts]
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        long = self.learn({piece for text in pieces for piece in text} - self.known.keys())
        known = (lambda x: long[x] if x in long else self.known[x]) if long else self.known.__getitem__
        return [b"".join(map(known, text)) for text in pieces]


def _slices(batch: pa.RecordBatch, size: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``size`` bytes in the second column, whole rows only."""
    _, offsets = text_parts(batch.column(1))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = min(high, batch.num_rows)


class Decoder:
    """The bytes of token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted((rank, token) for token, rank in ranks.items())
        self.flat = np.frombuffer(b"".join(x for _, x in tokens), dtype=np.uint8)
        self.start, self.size = (np.zeros(tokens[-1][0] + 1, dtype=np.int64) for _ in range(2))
        at = [x for x, _ in tokens]
        self.size[at] = [len(x) for _, x in tokens]
        self.start[at] = [0, *accumulate(len(x) for _, x in tokens[:-1])]

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """What each row's ids, little-endian 32-bit integers, stand for."""
        ids = np.frombuffer(b"".join(rows), dtype="<u4")
        if len(ids) and (ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id is outside the vocabulary")
        size = self.size[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        data = self.flat[np.repeat(self.start[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        edge = ends[np.concatenate(([0], np.cumsum([len(x) // 4 for x in rows]))).astype(np.int64)].tolist()
        return [data[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of ``docs`` (doc_id bigint, text string).

    Each match of ``pattern`` is encoded by itself, as byte-level BPE with
    ``ranks`` does, without special tokens; a piece that is itself a token is that
    token.  ``ids`` is binary: unsigned little-endian 32-bit integers.  With
    ``decoded``, the column ``data`` has the bytes that those ids decode to, in the
    same pass.  Null and empty texts have no tokens.  Rows keep their doc_id (null
    too), repeated rows are encoded alike, other columns are ignored, an empty
    table gives an empty result.  The ranks are broadcast: their number is the
    vocabulary's.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = decoder = None
        for batch in batches:
            encoder = encoder or Encoder(shared.value, pattern)
            decoder = decoder or Decoder(shared.value)
            for part in _slices(batch):
                ids = encoder.encode([x or "" for x in part.column(1).to_pylist()])
                data = [pa.array(decoder.decode(ids), pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), *data], names=["doc_id", "n_tokens", "ids", "data"][: 3 + decoded])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary" + ", data binary" * decoded)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids, data): each row of :func:`encode` with the bytes that its ids stand for.

    Null ids give null data, no ids give no bytes; an id outside the vocabulary is an error.
    """
    bounded_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            for part in _slices(batch):
                ids = part.column(1).to_pylist()
                data = [None if x is None else y for x, y in zip(ids, decoder.decode([x or b"" for x in ids]), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(1), pa.array(data, pa.binary())], names=["doc_id", "n_tokens", "ids", "data"])

    return encoded.select("doc_id", "ids", "n_tokens").mapInArrow(run, "doc_id long, n_tokens long, ids binary, data binary")
