"""A substring index: which rows of a table may contain a text, by the trigrams of their columns.

The table is written in the order of its row numbers, and beside it, in folders by
hash, which rows each trigram of each column is in, listed by runs of some thousand
rows.  A search looks up its rarest trigram, reads the rows that hold that one, and
tests those; the rest of the table is not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlit.functions import text as X

FOLDERS = 64
FEW_ROWS = 2000
#: Bytes of text, and row numbers, that one run of the index spans at most; a longer text is a run of its own.
RUN_BYTES, RUN_ROWS = 4 << 20, 1 << 15
PLACES = "field string, gram string, base long, offsets array<smallint>"


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text in lower case; none of a shorter or null one."""
    chars = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), ""), lambda c: c != "")
    shifted = lambda k: F.slice(chars, k, F.size(chars))
    triples = F.transform(F.arrays_zip(chars.alias("a"), shifted(2).alias("b"), shifted(3).alias("c")), lambda x: F.concat(x["a"], x["b"], x["c"]))
    return F.array_distinct(F.array_compact(triples))


def _runs(numbers: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Where a batch is cut: (start, end) of consecutive rows that one run of the index takes."""
    out, start, held = [], 0, 0
    for k, (n, size) in enumerate(zip(numbers.tolist(), sizes.tolist(), strict=True)):
        if k > start and (held + size > RUN_BYTES or not 0 <= n - int(numbers[start]) < RUN_ROWS):
            out.append((start, k))
            start, held = k, 0
        held += size
    return [*out, (start, len(numbers))] if len(numbers) else out


def _utf8(points: np.ndarray) -> pa.Array:
    """A text for each row of code points."""
    lengths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(points), pa.py_buffer(ends), pa.py_buffer(points.astype("<u4").tobytes().decode("utf-32-le").encode()))


def _held(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(trigrams as rows of code points, row): each distinct trigram of each text, sorted by trigram, then row.

    One item, but more if the texts have so many different characters that a trigram and a row are too long for 64 bits.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    letters = np.zeros(0x110000, np.int64)
    letters[points] = 1
    known = np.flatnonzero(letters)
    letter, place = max(1, len(known) - 1).bit_length(), max(1, len(texts) - 1).bit_length()
    if len(texts) > 1 and 3 * letter + place > 63:
        half = len(texts) // 2
        return [*_held(texts[:half]), *((g, r + half) for g, r in _held(texts[half:]))]
    letters[known] = np.arange(len(known))
    code, whole = letters[points], row[:-2] == row[2:]
    grams = (code[:-2] << 2 * letter | code[1:-1] << letter | code[2:])[whole]
    both = np.sort(grams << place | row[:-2][whole] if len(texts) > 1 else grams)
    both = both[np.diff(both, prepend=-1) != 0] << (0 if len(texts) > 1 else place)
    low, gram = (1 << letter) - 1, both >> place
    return [(known[np.stack([gram >> 2 * letter, gram >> letter & low, gram & low], axis=1)], both & (1 << place) - 1)] if len(both) else []


def _listed(fields: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For batches of row numbers and lower-case texts, the rows that hold each trigram of each field: a list for each run of rows."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for k, field in enumerate(fields, 1):
                sizes = pc.binary_length(batch.column(k)).to_numpy()
                for start, end in _runs(numbers, sizes):
                    for grams, rows in _held(batch.column(k).slice(start, end - start).to_pylist()):
                        begins = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]).any(axis=1)]))
                        offsets = pa.ListArray.from_arrays(pa.array(np.append(begins, len(rows)).astype(np.int32)), pa.array((numbers[start:end][rows] - numbers[start]).astype(np.int16)))
                        n = len(begins)
                        yield pa.RecordBatch.from_arrays([pa.array([field] * n, pa.string()), _utf8(grams[begins]), pa.array(np.full(n, numbers[start])), offsets], ["field", "gram", "base", "offsets"])

    return listed


def _folder(gram: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(folders)).cast("int")


def build(rows: DataFrame, columns: list[str], path: str, order: list[str], folders: int = FOLDERS) -> None:
    """Write the table and its index of ``columns`` below ``path``; rows are numbered in ``order``, with gaps.

    The index has a row for each distinct trigram of a column in each run of rows,
    with the list of those that hold it.  A column of the table may not be called
    ``number``; null cells have no trigrams.
    """
    spark = rows.sparkSession
    rows.orderBy(*order).withColumn("number", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/rows")
    texts = [F.lower(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))).alias(f"text{k}") for k, c in enumerate(columns)]
    places = spark.read.parquet(f"{path}/rows").select("number", *texts).mapInArrow(_listed(columns), PLACES)
    places = places.withColumn("folder", _folder(F.col("gram"), folders)).withColumn("n", F.size("offsets"))
    # sorted within files, so that a trigram is found by their statistics; one that most rows have is in many files
    dealt = places.repartition("folder", F.pmod(F.xxhash64("base"), F.lit(4)))
    dealt.sortWithinPartitions("folder", "gram", "field", "base").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/places")
    held = spark.read.schema(f"{PLACES}, n int, folder int").parquet(f"{path}/places")
    held.groupBy("folder", "gram", "field").agg(F.sum("n").alias("n")).repartition("folder").sortWithinPartitions("folder", "gram").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/counts")
    spark.range(1).select(F.lit(folders).alias("folders"), F.array(*map(F.lit, columns)).alias("columns")).write.mode("overwrite").json(f"{path}/about")


@dataclass(frozen=True)
class Found:
    """What a search read: the trigram it looked up in each column (none if the query is too short), how many rows hold one, and the rows that match."""

    grams: dict[str, str]
    candidates: int | None
    rows: DataFrame


def search(spark: SparkSession, path: str, query: str | None, columns: list[str] | None = None) -> Found:
    """The rows of an indexed table of which any of ``columns`` (all indexed ones) contains the trimmed query, in any case.

    A blank query matches all; one of less than three characters has no trigram and
    is answered by a scan.  Columns that aren't indexed are an error.
    """
    about = spark.read.schema("folders int, columns array<string>").json(f"{path}/about").first()
    columns = columns or about.columns
    if unknown := set(columns) - set(about.columns):
        raise ValueError(f"not indexed: {', '.join(sorted(unknown))}")
    rows, wanted = spark.read.parquet(f"{path}/rows"), (query or "").strip().lower()
    matching = rows.where(X.matches_query(query, columns)).drop("number")
    if len(wanted) < 3:
        return Found({}, None, matching)
    grams = sorted({wanted[k : k + 3] for k in range(len(wanted) - 2)})
    asked = spark.range(1).select(F.explode(F.array(*map(F.lit, grams))).alias("gram")).select("gram", _folder(F.col("gram"), about.folders).alias("folder")).collect()  # the query's own
    counts = spark.read.schema("gram string, field string, n long, folder int").parquet(f"{path}/counts").where(F.col("folder").isin([r.folder for r in asked]) & F.col("gram").isin(grams) & F.col("field").isin(columns))
    n = {(r.field, r.gram): r.n for r in counts.collect()}  # some for each trigram of the query
    rarest = {c: min(grams, key=lambda g: (n.get((c, g), 0), g)) for c in columns}
    rarest = {c: g for c, g in rarest.items() if n.get((c, g))}  # a trigram that a column never has: no row by that column
    candidates = sum(n[c, g] for c, g in rarest.items())
    if not rarest:
        return Found({}, 0, matching.where("false"))
    folder_of = {r.gram: r.folder for r in asked}
    at = F.lit(False)
    for c, g in rarest.items():
        at = at | ((F.col("folder") == folder_of[g]) & (F.col("gram") == g) & (F.col("field") == c))
    held = spark.read.schema(f"{PLACES}, folder int").parquet(f"{path}/places").where(F.col("folder").isin([folder_of[g] for g in rarest.values()]) & F.col("gram").isin(list(rarest.values())) & at)
    numbers = held.select("base", F.explode("offsets").alias("offset")).select((F.col("base") + F.col("offset")).alias("number")).distinct()
    if candidates <= FEW_ROWS:  # a filter that reaches the files of the table
        chosen = rows.where(F.col("number").isin([r.number for r in numbers.collect()]))
    else:
        chosen = rows.join(numbers, "number", "left_semi")
    return Found(rarest, candidates, chosen.where(X.matches_query(query, columns)).drop("number"))
