"""Text classification of documents with spark.ml.

Words and pairs of words are counted by tasks from Arrow batches, first the words,
then the pairs of words that are frequent enough for the vocabulary; so the pairs
that no vocabulary can hold are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, Normalizer, StopWordsRemover, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.sources.durable import durable, stored

LEAST_LABELLED = 20
PENALTY = 1e-4
WORD = re.compile(r"\w\w+")
#: Texts that are counted together; words, or pairs, that a task holds before it hands its counts on.
TEXTS, HELD = 256, 1 << 20


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    labels: list[str]
    report: DataFrame


def prepared(documents: DataFrame) -> DataFrame:
    """``documents`` (pmid, title_e, abstract, subjects, ...) with ``__text`` and ``__subjects``."""
    return documents.withColumn("__text", X.doc_text("title_e", "abstract")).withColumn("__subjects", X.subjects_list("subjects"))


def has_content(rows: DataFrame) -> DataFrame:
    return rows.where("__text <> '' or size(__subjects) > 0")


def _stop() -> frozenset[str]:
    return frozenset(StopWordsRemover.loadDefaultStopWords("english"))


def _blocks(texts: pa.Array) -> Iterator[list[str]]:
    for k in range(0, len(texts), TEXTS):
        yield [t or "" for t in texts.slice(k, TEXTS).to_pylist()]


def _words(stop: frozenset[str]):
    """For batches of texts: word, how often it is there, in how many texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(often), pa.string()), pa.array(list(often.values()), pa.int64()), pa.array([within[w] for w in often], pa.int64())], ["term", "n", "texts"])

        often, within = Counter(), Counter()
        for batch in batches:
            for texts in _blocks(batch.column(0)):
                for text in texts:
                    found = [w for w in WORD.findall(text.lower()) if w not in stop]
                    often.update(found)
                    within.update(set(found))
                    if len(often) >= HELD:
                        yield flush()
                        often, within = Counter(), Counter()
        yield flush()

    return counted


def _numbered(texts: list[str], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, number) of each word but stop words, whose number is -2; -1 for an unknown word."""
    numbers, sizes = [], []
    for text in texts:
        found = [known.get(w, -1) for w in WORD.findall(text.lower())]
        numbers += found
        sizes.append(len(found))
    number = np.array(numbers, np.int64)
    text, kept = np.repeat(np.arange(len(texts)), sizes), number != -2
    return text[kept], number[kept]


def _paired(text: np.ndarray, number: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of each two known words that follow each other in a text."""
    both = (text[1:] == text[:-1]) & (number[1:] >= 0) & (number[:-1] >= 0)
    return text[:-1][both], (number[:-1] * most + number[1:])[both]


def _pairs(known: dict[str, int], most: int):
    """For batches of texts: the code of a pair of known words, how often it is there, in how many texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            codes, which = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            often, within = (np.bincount(which, np.concatenate([h[k] for h in held]), len(codes)).astype(np.int64) for k in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(often), pa.array(within)], ["code", "n", "texts"])

        held, size = [], 0
        for batch in batches:
            for texts in _blocks(batch.column(0)):
                text, code = _paired(*_numbered(texts, known), most)
                order = np.lexsort((text, code))
                text, code = text[order], code[order]
                new = np.diff(code, prepend=-1) != 0
                begins = np.flatnonzero(new)
                first = new | (np.diff(text, prepend=-1) != 0)
                held.append((code[begins], np.diff(np.append(begins, len(code))), np.add.reduceat(first, begins, dtype=np.int64) if len(begins) else begins))
                size += len(begins)
                if size >= HELD:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return counted


class WordCounts(Transformer, HasInputCol, HasOutputCol):
    """How often each word and pair of words of a vocabulary is in a text, as a vector."""

    vocabSize = Param(Params._dummy(), "vocabSize", "most words and pairs of the vocabulary", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "least texts that a word or pair is in", TypeConverters.toFloat)

    def __init__(self, vocabulary: list[str], vocabulary_size: int, least_documents: int, inputCol: str = "__text", outputCol: str = "__counts"):
        super().__init__()
        self.vocabulary = vocabulary
        self._set(inputCol=inputCol, outputCol=outputCol, vocabSize=vocabulary_size, minDF=float(least_documents))

    def getVocabSize(self) -> int:
        return self.getOrDefault(self.vocabSize)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), F.arrow_udf(_vectors(self.vocabulary), VectorUDT())(self.getInputCol()))


def _vectors(vocabulary: list[str]):
    """For batches of texts, the counts of the vocabulary's words and pairs as sparse vectors."""
    known = {w: k for k, w in enumerate(sorted({w for term in vocabulary for w in term.split(" ")}))}
    most, single = len(known), np.full(len(known), -1)
    pairs = []
    for place, term in enumerate(vocabulary):
        at = [known[w] for w in term.split(" ")]
        if len(at) == 1:
            single[at[0]] = place
        else:
            pairs.append((at[0] * most + at[1], place))
    codes, places = np.array([*sorted(pairs), (np.iinfo(np.int64).max, -1)], np.int64).T.copy()
    known |= dict.fromkeys(_stop(), -2)

    def counted(texts: list[str]) -> pa.Array:
        text, number = _numbered(texts, known)
        of_pair, code = _paired(text, number, most)
        at = np.searchsorted(codes, code)
        place = np.concatenate([np.append(single, -1)[number], np.where(codes[at] == code, places[at], -1)])
        both = np.concatenate([text, of_pair]) * len(vocabulary) + place
        cells, n = np.unique(both[place >= 0], return_counts=True)
        offsets = pa.array(np.searchsorted(cells, np.arange(len(texts) + 1) * len(vocabulary)).astype(np.int32))
        indices, values = pa.array((cells % max(1, len(vocabulary))).astype(np.int32)), pa.array(n.astype(np.float64))
        columns = [pa.array(np.zeros(len(texts), np.int8)), pa.array(np.full(len(texts), len(vocabulary), np.int32)), pa.ListArray.from_arrays(offsets, indices), pa.ListArray.from_arrays(offsets, values)]
        return pa.StructArray.from_arrays(columns, ["type", "size", "indices", "values"])

    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([counted(texts) for texts in _blocks(batch)] or [counted([])])

    return vectors


def word_counts(texts: DataFrame, vocabulary: int = 8000, least_documents: int = 2) -> WordCounts:
    """The counts of the ``vocabulary`` most frequent words and pairs of ``texts`` (__text), of those in ``least_documents`` texts.

    A pair is no more frequent than its words, so pairs are counted of those words only
    that are more frequent than the last word of a vocabulary of words alone.  Equally
    frequent ones go by length, then by code point.
    """
    by = lambda rows, key: rows.groupBy(key).agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")).where(F.col("texts") >= least_documents)
    texts = texts.select("__text")
    words = by(texts.mapInArrow(_words(_stop()), "term string, n long, texts long"), "term")
    words = [(r.term, r.n) for r in words.orderBy(F.desc("n"), "term").limit(vocabulary).collect()]  # as many rows as the vocabulary
    least = words[-1][1] if len(words) == vocabulary else 0
    frequent = sorted(w for w, n in words if n > least)
    most = len(frequent)
    coded = by(texts.mapInArrow(_pairs({w: k for k, w in enumerate(frequent)} | dict.fromkeys(_stop(), -2), most), "code long, n long, texts long"), "code")
    pairs = [(f"{frequent[r.code // most]} {frequent[r.code % most]}", r.n) for r in coded.where(F.col("n") > least).orderBy(F.desc("n"), "code").limit(vocabulary).collect()]
    ranked = sorted([*words, *pairs], key=lambda x: (-x[1], " " in x[0], x[0]))
    return WordCounts([term for term, _ in ranked[:vocabulary]], vocabulary, least_documents)


def features() -> list:
    """TF-IDF of the counts, row-normalised, and an indicator for each subject."""
    return [
        IDF(inputCol="__counts", outputCol="__weighed"),
        Normalizer(inputCol="__weighed", outputCol="__tfidf"),
        CountVectorizer(inputCol="__subjects", outputCol="__indicators", binary=True, minDF=1),
        VectorAssembler(inputCols=["__tfidf", "__indicators"], outputCol="__features"),
    ]


def train(documents: DataFrame, target: str, seed: int = 42, iterations: int = 2000, vocabulary: int = 8000) -> Trained | None:
    """Fit on 80 % of the labelled documents and report on the rest; None below ``LEAST_LABELLED`` labels.

    Classes weigh n / (k * n_class).  The split is by a hash of the id, so reruns agree.
    """
    rows = has_content(prepared(documents)).where(X.first_filled(target) != "").withColumn("__label", F.col(target))
    # the texts with a label are read twice for the vocabulary and once for their counts; those are read by the weights, each of the iterations and the report
    rows = stored(rows.select("pmid", "__label", (F.pmod(F.xxhash64("pmid", F.lit(seed)), F.lit(5)) == 0).alias("__test"), "__subjects", "__text"))
    sizes = rows.groupBy("__label").agg(F.count("*").alias("count"), F.count_if(~F.col("__test")).alias("fit")).toPandas()  # a row for each class
    if sizes["count"].sum() < LEAST_LABELLED:
        return None
    fit, sizes = rows.where("not __test"), sizes[sizes["fit"] > 0]
    weights = [(label, float(sizes["fit"].sum() / (len(sizes) * n))) for label, n in zip(sizes["__label"], sizes["fit"], strict=True)]
    class_weights = documents.sparkSession.createDataFrame(weights, "__label string, __weight double")
    index = StringIndexer(inputCol="__label", outputCol="__index", handleInvalid="keep", stringOrderType="alphabetAsc").fit(fit)
    counts = word_counts(fit, vocabulary)
    held = durable(counts.transform(rows).select("pmid", "__label", "__test", "__subjects", "__counts"))
    # the classes that are there: one for labels that are not known has no row, and its intercept no minimum
    weighed = index.copy().setHandleInvalid("error").transform(held.where("not __test").join(class_weights, "__label"))
    # Two classes have the same minimum with one vector, the difference of their two; the penalty of two vectors, each half of it, is half of its own.
    kind, penalty = ("binomial", PENALTY / 2) if len(weights) == 2 else ("multinomial", PENALTY)
    logistic = LogisticRegression(featuresCol="__features", labelCol="__index", weightCol="__weight", maxIter=iterations, family=kind, regParam=penalty)
    learned = Pipeline(stages=[*features(), logistic]).fit(weighed)
    named = IndexToString(inputCol="prediction", outputCol="__predicted", labels=[*index.labels, "__unknown"])
    judged = named.transform(learned.transform(held.where("__test"))).select("__label", "__predicted")
    model = PipelineModel([counts, *learned.stages[:-1], index, learned.stages[-1], named])
    return Trained(model, list(index.labels), report(judged))


def predict(trained: Trained, documents: DataFrame, target: str) -> DataFrame:
    """``documents`` without a label but with content: pmid, the predicted class and its confidence, to 3 places."""
    rows = has_content(prepared(documents)).where(X.first_filled(target) == "").withColumn("__label", F.lit(trained.labels[0])).withColumn("__weight", F.lit(1.0))
    done = trained.model.transform(rows)
    return done.select("pmid", F.col("__predicted").alias(f"{target}_predicted"), F.bround(F.array_max(vector_to_array("probability")), 3).alias(f"{target}_predicted_confidence"))


def report(judged: DataFrame, label: str = "__label", predicted: str = "__predicted") -> DataFrame:
    """(label, precision, recall, f1, support) for each class; 0 where a ratio has no cases."""
    counts = judged.groupBy(F.col(label).alias("l"), F.col(predicted).alias("p")).count()
    sides = counts.select(F.col("l").alias("label"), F.col("count").alias("support"), F.lit(0).cast("long").alias("chosen"), F.when(F.col("l") == F.col("p"), F.col("count")).otherwise(0).alias("right"))
    sides = sides.unionByName(counts.select(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("count").alias("chosen"), F.lit(0).cast("long").alias("right")))
    total = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("chosen").alias("chosen"), F.sum("right").alias("right"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    total = total.withColumn("precision", ratio("right", "chosen")).withColumn("recall", ratio("right", "support"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return total.select("label", "precision", "recall", f1.alias("f1"), "support")


def sample(documents: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` documents by a hash of the id: the same ones whatever the partitioning."""
    return documents.orderBy(F.xxhash64("pmid", F.lit(seed)), "pmid").limit(n)
