"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word is a run of letters, A-Z lowered.  Its vector is the sum of four hashed
embeddings: of the word and of its first 4, 6 and 8 bytes, so that unseen words
share what is known of their beginnings.  Filters of width 1, 2 and 3 run over a
text's word vectors, each filter keeps its maximum, and a logistic unit reads
those maxima.  Training is numpy only: logistic loss with balanced classes,
AdaGrad steps, gradients through each maximum's place.

A share of the training rows stays out of training and calibrates: for each
language the logit at which F1 is best there becomes the decision threshold and
maps to the score ``DECISION``.  The language is read from the text itself, by
which list of function words it hits most; the columns lang, source and doc_id
and the labels are no input of a score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlit.llm.session import bounded_batches
from arborlit.llm.textblocks import U64, Block, _BYTE_CODES_LOWER, blocks, mix, prefix_sums, runs, span_hashes

DECISION = 0.3
BUCKET_BITS = 15
PREFIXES = (4, 6, 8)
TABLES = 1 + len(PREFIXES)
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1

# Frequent function words of the languages that are told apart.
FUNCTION_WORDS = (
    ("en", "the and of to in that is was for on are with as it he be at by this have from or had not but what all were when we there"),
    ("de", "der die und das mit sich nicht von ist den auf ein eine dem zu im für des auch als sie wird bei aus einer nach"),
    ("fr", "le les des que une dans qui est pour pas sur par plus avec ce il sont la du et au en ne se aux"),
    ("es", "el los las que por con para una del se su como más lo pero sus al es y un está ser son"),
)

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashed ids of the words, (words, TABLES) of uint16, and how many each row has."""
    found = runs(block, _LETTER[block.data])
    sums = prefix_sums(_BYTE_CODES_LOWER[block.data])
    ids = np.empty((len(found.start), TABLES), dtype=np.uint16)
    for k, size in enumerate((0, *PREFIXES)):
        end = np.minimum(found.start + size, found.end) if size else found.end
        ids[:, k] = mix(span_hashes(sums, found.start, end) + U64(k)) >> U64(64 - BUCKET_BITS)
    return ids, np.diff(found.first)


def _language_table() -> np.ndarray:
    """Language (from 1; 0: none) by the bucket of a whole word."""
    table = np.zeros(1 << BUCKET_BITS, dtype=np.int8)
    for k, (_, known) in enumerate(FUNCTION_WORDS):
        data = known.encode()
        ids, _ = features(Block(np.zeros(1), np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)])))
        table[ids[:, 0]] = np.where(table[ids[:, 0]] == 0, k + 1, -1)  # a word of two languages tells nothing
    return np.maximum(table, 0)


def languages(ids: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The language of each text, 0 if no function word is hit."""
    row = np.repeat(np.arange(len(counts)), counts)
    kinds = len(FUNCTION_WORDS) + 1
    votes = np.bincount(row * kinds + table[ids[:, 0]], minlength=len(counts) * kinds).reshape(-1, kinds)
    votes[:, 0] = 0
    return np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), 0)


@dataclass
class Model:
    """Weights, and the threshold of each language as a logit."""

    embedding: np.ndarray  # (TABLES, buckets, dim)
    filters: list[np.ndarray]  # for each width (width, dim, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    offset: float
    thresholds: np.ndarray

    def vectors(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word vectors with ``PAD`` zero rows after each text, where each text begins, and each word's row."""
        first = np.cumsum(counts + PAD) - counts - PAD
        place = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))
        out = np.zeros((len(ids) + PAD * len(counts) + PAD, self.embedding.shape[2]), dtype=np.float32)
        total = self.embedding[0][ids[:, 0]]
        for k in range(1, TABLES):
            total = total + self.embedding[k][ids[:, k]]
        out[place] = total
        return out, first, place

    def responses(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For each width what its filters give at each position."""
        n = len(vectors) - PAD
        out = []
        for filters, bias in zip(self.filters, self.bias, strict=True):
            z = vectors[:n] @ filters[0] + bias
            for k in range(1, len(filters)):
                z += vectors[k : n + k] @ filters[k]
            out.append(z)
        return out

    def logits(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        pooled = np.zeros((len(counts), len(self.out)), dtype=np.float32)
        full = np.flatnonzero(counts)
        if len(full):
            vectors, first, _ = self.vectors(ids, counts)
            edges = np.stack((first[full], first[full] + counts[full]), axis=1).reshape(-1)
            pooled[full] = np.concatenate([np.maximum.reduceat(z, edges, axis=0)[::2] for z in self.responses(np.concatenate((vectors, np.zeros_like(vectors[:1]))))], axis=1)
        return np.maximum(pooled, 0) @ self.out + self.offset

    def scores(self, ids: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        above = self.logits(ids, counts).astype(np.float64) - self.thresholds[languages(ids, counts, table)]
        return 1 / (1 + np.exp(-np.clip(above, -30, 30) - np.log(DECISION / (1 - DECISION))))


def _best_threshold(logits: np.ndarray, truth: np.ndarray) -> float:
    """The middle of the gap between neighbouring logits at which F1 is best."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + truth.sum())
    ordered = logits[order]
    last = np.append(ordered[:-1] > ordered[1:], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    return float(ordered[best] if best + 1 == len(order) else (ordered[best] + ordered[best + 1]) / 2)


def fit(texts: list[tuple[np.ndarray, int]], dim: int = 16, filters: int = 8, epochs: int = 6, batch: int = 64, rate: float = 0.1, seed: int = 7, least: int = 25) -> Model | None:
    """A model from (ids, label) pairs; None without both labels.  Every fifth text calibrates."""
    truth = np.array([y for _, y in texts], dtype=np.float32)
    if not 0 < truth.sum() < len(truth):
        return None
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    model = Model(normal(TABLES, 1 << BUCKET_BITS, dim), [3 * normal(w, dim, filters) for w in WIDTHS], [np.zeros(filters, dtype=np.float32) for _ in WIDTHS], normal(len(WIDTHS) * filters), 0.0, np.zeros(len(FUNCTION_WORDS) + 1))
    held = np.arange(len(texts)) % 5 == 4
    if not 0 < truth[~held].sum() < (~held).sum():
        held[:] = False
    train = np.flatnonzero(~held)
    share = truth[train].mean()
    weight = np.where(truth == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    past = {"e": np.full(model.embedding.shape[:2], 1e-6, dtype=np.float32), "o": np.full(len(model.out), 1e-6, dtype=np.float32), "c": 1e-6}
    past |= {f"f{k}": np.full_like(x, 1e-6) for k, x in enumerate(model.filters)} | {f"b{k}": np.full_like(x, 1e-6) for k, x in enumerate(model.bias)}

    def step(name: str, value: np.ndarray, grad: np.ndarray) -> None:
        past[name] += grad * grad
        value -= rate * grad / np.sqrt(past[name])

    for _ in range(epochs):
        order = rng.permutation(train)
        for low in range(0, len(order), batch):
            rows = order[low : low + batch]
            counts = np.array([len(texts[k][0]) for k in rows])
            ids = np.concatenate([texts[k][0] for k in rows])
            if not len(ids):
                continue
            vectors, first, place = model.vectors(ids, counts)
            word = np.full(len(vectors), -1)
            word[place] = np.arange(len(ids))
            at = []
            for z in model.responses(vectors):
                at.append(np.array([a + z[a : a + n].argmax(axis=0) if n else np.full(z.shape[1], a) for a, n in zip(first, counts, strict=True)]))
            pooled = np.concatenate([np.maximum(z[p, np.arange(z.shape[1])], 0) for z, p in zip(model.responses(vectors), at, strict=True)], axis=1)
            pooled[counts == 0] = 0
            logit = pooled @ model.out + model.offset
            delta = weight[rows] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - truth[rows]) / len(rows)
            back = (delta[:, None] * model.out) * (pooled > 0)
            change, words_at = [], []
            for k, w in enumerate(WIDTHS):
                own, grad = back[:, k * filters : (k + 1) * filters], np.zeros_like(model.filters[k])
                for j in range(w):
                    grad[j] = np.einsum("df,dfe->ef", own, vectors[at[k] + j])
                    change.append((own[:, :, None] * model.filters[k][j].T).reshape(-1, dim))
                    words_at.append(word[(at[k] + j).reshape(-1)])
                step(f"f{k}", model.filters[k], grad)
                step(f"b{k}", model.bias[k], own.sum(axis=0))
            change, words_at = np.concatenate(change), np.concatenate(words_at)
            real = (words_at >= 0) & change.any(axis=1)
            change, words_at = change[real], words_at[real]
            for k in range(TABLES):
                bucket, where = np.unique(ids[words_at, k], return_inverse=True)
                grad = np.zeros((len(bucket), dim), dtype=np.float32)
                np.add.at(grad, where, change)
                past["e"][k, bucket] += (grad * grad).mean(axis=1)
                model.embedding[k, bucket] -= rate * grad / np.sqrt(past["e"][k, bucket])[:, None]
            grad = delta @ pooled
            past["c"] += float(delta.sum()) ** 2
            model.offset -= rate * float(delta.sum()) / past["c"] ** 0.5
            step("o", model.out, grad)

    judged = np.flatnonzero(held if held.any() else ~held)
    table = _language_table()
    sizes = [np.array([len(texts[k][0])]) for k in judged]
    logits = np.array([float(model.logits(texts[k][0], n)[0]) for k, n in zip(judged, sizes, strict=True)])
    spoken = np.array([int(languages(texts[k][0], n, table)[0]) for k, n in zip(judged, sizes, strict=True)])
    common = _best_threshold(logits, truth[judged]) if truth[judged].any() else 0.0
    for k in range(len(model.thresholds)):
        own = spoken == k
        model.thresholds[k] = _best_threshold(logits[own], truth[judged][own]) if truth[judged][own].sum() >= least else common
    return model


def held_out(doc_id: Column) -> Column:
    """Whether the id's remainder keeps its label from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000, **options) -> Model | None:
    """Fit on at most ``sample_rows`` labelled rows that aren't held out, the first by hash of doc_id.

    That bound is the only one on the sample; their texts are read whole (of rows
    that repeat a doc_id the least text), eight bytes a word.  One task trains, so the driver holds the model only, whose size is fixed.
    ``labels`` has doc_id and toxic (0/1); of several labels of a doc_id the
    largest holds, null ones don't count.
    """
    bounded_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, done = batch.column(2).to_pylist(), 0
            for block in blocks(iter([batch])):
                ids, counts = features(block)
                cut = np.split(ids, np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(block.ids), pa.array(label[done : done + len(block)], pa.int32()), pa.array([x.tobytes() for x in cut], pa.binary())], names=["doc_id", "toxic", "ids"])
                done += len(block)

    def learn(table: pa.Table) -> pa.Table:
        found = sorted(zip(*(table.column(k).to_pylist() for k in ("doc_id", "ids", "toxic")), strict=True))
        model = fit([(np.frombuffer(ids, dtype=np.uint16).reshape(-1, TABLES), toxic) for _, ids, toxic in found], **options)
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")
    described = rows.mapInArrow(describe, "doc_id long, toxic int, ids binary")
    done = described.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(learn, "model binary").collect()
    return pickle.loads(done[0].model) if done else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted) for each row of ``docs`` (doc_id, text string).

    ``score`` is 0 to 1 and depends on the whole text only; null and empty texts
    get the score of a text without words; ``predicted`` is 1 from ``DECISION``
    on.  Without a model (no labels of both kinds) scores are 0.  Rows keep their
    doc_id (null too), repeated rows score alike, other columns are ignored, an
    empty table gives an empty result.  The model is broadcast; its size is fixed.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _language_table()
        for batch in batches:
            low = 0
            for block in blocks(iter([batch]), size=1 << 19):
                found = shared.value.scores(*features(block), table) if shared.value else np.zeros(len(block))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(block)), pa.array(found), pa.array((found >= DECISION).astype(np.int32))], names=["doc_id", "score", "predicted"])
                low += len(block)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`score` doesn't predict to be toxic.

    A null text counts as empty; null and repeated ids and repeated rows are rows
    like others; an empty table gives an empty result; without a model all rows stay.
    """
    bounded_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _language_table()
        for batch in batches:
            low = 0
            for block in blocks(iter([pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(at)], names=["doc_id", "text"])]), size=1 << 19):
                part = batch.slice(low, len(block))
                low += len(block)
                yield part.filter(pa.array(shared.value.scores(*features(block), table) < DECISION)) if shared.value else part

    return docs.mapInArrow(run, docs.schema)
