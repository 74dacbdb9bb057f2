"""Merkle fixity audit of WARC replicas.

An archive is a table of stored records: (file, page_id, record), as rendered from
pages by :func:`records` or read from WARC files by :func:`read_archive`.  A file's
tree has a leaf for each slot, that is each page_id of the file: the digests and
lengths of the slot's records.  An inner node hashes the digests of up to ``FAN``
children together with their ordered byte ranges, counted from the node's own
beginning.  So a record that changes, also in length, changes the nodes above it
and no others, and a missing or added one moves no other record to another leaf.

Two replicas are compared from the roots down: only children of nodes that differ
are compared next, until the differing slots are found, and only these slots'
records are compared by digest and length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.llm.session import durable

FILE_IDS = 256
FAN_BITS = 4
FAN = 1 << FAN_BITS
DEPTH = 2  # FILE_IDS slots are FAN ** DEPTH
CRLF = "\r\n"
START = b"WARC/1.1\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a page's WARC record; null url and html count as empty."""
    html = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(f">{CRLF}WARC-Date: 1970-01-01T00:00:00Z{CRLF}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(CRLF + CRLF),
        html,
        F.lit(CRLF + CRLF),
    )


def file_of(page_id: Column) -> Column:
    return F.floor(page_id / FILE_IDS).cast("long")


def records(pages: DataFrame) -> DataFrame:
    """(file, page_id, record): the records of ``pages`` (page_id, url, html), not yet in order.

    A file holds ``FILE_IDS`` consecutive page ids (null ids: file null).
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    return rows.select(file_of(F.col("page_id")).alias("file"), "page_id", "record")


def write_archive(stored: DataFrame, path: str) -> None:
    """Write records as WARC files below ``path``, one folder a file number, in order of page_id."""
    cut = F.expr(f"substring(record, 1, length(record) - {2 * len(CRLF)})")
    rows = stored.repartition("file").sortWithinPartitions("file", "page_id", "record")
    rows.select("file", cut.alias("value")).write.partitionBy("file").option("lineSep", CRLF + CRLF).text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, page_id, record binary) of the WARC files below ``path``.

    Records are told apart by their Content-Length.  Where it doesn't lead to the
    next record or the file's end, or is missing, a record ends where the next
    one starts; bytes before the first record are a record without page_id.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folder = next((x[5:] for x in name.split("/") if x.startswith("file=")), "")
                cuts = list(cut_records(data))
                ids = [page_of(x) for x in cuts]
                own = int(folder) if folder.lstrip("-").isdigit() else None
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(cuts), pa.int64()), pa.array(ids, pa.int64()), pa.array(cuts, pa.binary())], names=["file", "page_id", "record"])

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return found.select("path", "content").mapInArrow(parse, "file long, page_id long, record binary")


def cut_records(data: bytes) -> Iterator[bytes]:
    """The records of a WARC file."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at) if data.startswith(START, at) else -1
        size = next((x[15:].strip() for x in data[at:head].split(b"\r\n") if x.lower().startswith(b"content-length:")), b"") if head >= 0 else b""
        end = head + 8 + int(size) if size.isdigit() else -1
        if not (at < end <= len(data) and (end == len(data) or data.startswith(START, end))):
            end = data.find(START, at + 1)
            end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def page_of(stored: bytes) -> int | None:
    """The page id that a record names."""
    _, named, rest = stored.partition(b"<urn:page:")
    digits = rest.partition(b">")[0]
    return int(digits) if named and digits.lstrip(b"-").isdigit() else None


def leaves(stored: DataFrame, spread: int = 1) -> DataFrame:
    """(file, page_id, book, slot, size, digest, copies): the different records of an archive (file, page_id, record), and how often each is held.

    Records are hashed where they are read: only digests and lengths are
    shuffled.  ``book`` is the file, for null page ids one of ``spread`` negative numbers by digest.
    """
    rows = stored.select("file", "page_id", F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("digest"))
    mixed = F.conv(F.substring("digest", 1, 12), 16, 10).cast("long")
    book = F.when(F.col("page_id").isNull() | F.col("file").isNull(), -1 - F.pmod(F.floor(mixed / FILE_IDS), F.lit(spread)) - (1 << 62)).otherwise(F.col("file"))
    slot = F.pmod(F.coalesce("page_id", mixed), F.lit(FILE_IDS))
    rows = rows.withColumn("book", book.cast("long")).withColumn("slot", slot.cast("long"))
    return rows.groupBy("file", "page_id", "book", "slot", "size", "digest").agg(F.count("*").alias("copies"))


def placed(leaf: DataFrame) -> DataFrame:
    """``leaves`` with ``first``, the offset of the first copy: records lie in a book by slot, page_id and digest, copies one after another."""
    order = W.partitionBy("book").orderBy("slot", "page_id", "digest")
    return leaf.withColumn("first", F.sum(F.col("size") * F.col("copies")).over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size") * F.col("copies"))


def slots(leaf: DataFrame) -> DataFrame:
    """(book, node, size, digest): the lowest level of every book's tree."""
    each = F.concat_ws(":", "page_id", "digest", F.col("size").cast("string"), F.col("copies").cast("string"))
    grouped = leaf.groupBy("book", F.col("slot").alias("node")).agg(F.sum(F.col("size") * F.col("copies")).alias("size"), F.sort_array(F.collect_list(each)).alias("c"))
    return grouped.select("book", "node", "size", F.sha2(F.array_join("c", ","), 256).alias("digest"))


def parents(level: DataFrame) -> DataFrame:
    """The next level: node n covers the children n * FAN to n * FAN + FAN - 1, each with its byte range from n's beginning."""
    grouped = level.groupBy("book", F.shiftright("node", FAN_BITS).alias("node")).agg(F.sum("size").alias("size"), F.sort_array(F.collect_list(F.struct("node", "size", "digest"))).alias("c"))
    ends = F.transform("c", lambda x, k: F.aggregate(F.slice("c", 1, k + 1), F.lit(0).cast("long"), lambda n, y: n + y["size"]))
    text = F.transform(F.arrays_zip(F.col("c"), ends.alias("end")), lambda x: F.concat_ws(":", x["c"]["node"].cast("string"), (x["end"] - x["c"]["size"]).cast("string"), x["end"].cast("string"), x["c"]["digest"]))
    return grouped.select("book", "node", "size", F.sha2(F.array_join(text, ","), 256).alias("digest"))


def tree(leaf: DataFrame) -> list[DataFrame]:
    """The levels of every book's tree, slots first; the last one has one node a book."""
    levels = [durable(slots(leaf))]
    for _ in range(DEPTH):
        levels.append(durable(parents(levels[-1])))
    return levels


def mismatches(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """(book, node) of the slots that differ or that one side lacks, found from the roots down."""
    suspects = None
    for a, b in zip(reversed(ours), reversed(theirs), strict=True):
        if suspects is not None:
            above = suspects.toDF("f", "n")
            of = lambda x: x.join(above, (x["book"] == F.col("f")) & (F.shiftright(x["node"], FAN_BITS) == F.col("n")), "left_semi")  # noqa: E731, B023
            a, b = of(a), of(b)
        sides = a.select("book", "node", F.col("digest").alias("a"), F.lit(None).cast("string").alias("b")).unionAll(b.select("book", "node", F.lit(None).cast("string"), F.col("digest")))
        both = sides.groupBy("book", "node").agg(F.max("a").alias("a"), F.max("b").alias("b"))
        suspects = durable(both.where(~F.col("a").eqNullSafe(F.col("b"))).select("book", "node"))
    return suspects


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(file, page_id, offset, length, sha256, root, replica_root, corrupt, shifted) for each record of the archive ``ours``.

    Both are tables of stored records (file, page_id, record string or binary);
    other columns are ignored.  Records lie in a file by page_id, equal ids by
    digest; a page_id may have any number of records, and rows that repeat are
    records of their own.  ``corrupt`` holds where the replica has no such record
    (page_id, digest and length) or fewer copies of it: the last ones are
    missing.  ``shifted`` holds for the others where the replica has them at
    another offset.  Records that only the replica has change its root.  Records
    with a null page_id or file lie in files of their own, dealt by digest, and
    name the roots of those; a null record counts as an empty one.  A file that
    the replica lacks has a null ``replica_root``.  Empty archives give an empty result.
    """
    stored = lambda x: x.select(F.col("file").cast("long").alias("file"), F.col("page_id").cast("long").alias("page_id"), F.coalesce("record", F.lit("").cast(x.schema["record"].dataType)).alias("record"))
    ours, theirs = stored(ours), stored(theirs)
    spread = max(x.where("page_id is null or file is null").count() // FILE_IDS + 1 for x in (ours, theirs))
    mine, other = durable(placed(leaves(ours, spread))), durable(placed(leaves(theirs, spread)))
    left, right = tree(mine), tree(other)
    bad = mismatches(left, right)
    roots = lambda level, name: level[-1].select("book", F.col("digest").alias(name))
    both = roots(left, "root").join(roots(right, "replica_root"), "book", "left")
    # replica's records are looked up only in books whose roots differ
    other = other.join(both.where("not root <=> replica_root").select("book"), "book", "left_semi")
    there = other.select("book", "slot", F.coalesce("page_id", F.lit(0)).alias("p"), "size", "digest", F.col("copies").alias("held"), F.col("first").alias("begins"))
    wrong = bad.select("book", F.col("node").alias("slot"), F.lit(True).alias("bad"))
    out = mine.withColumn("p", F.coalesce("page_id", F.lit(0))).join(both, "book").join(F.broadcast(wrong) if bad.count() <= 1000 else wrong, ["book", "slot"], "left")
    out = out.join(there, ["book", "slot", "p", "size", "digest"], "left")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    corrupt = F.col("bad").isNotNull() & (F.col("copy") >= F.coalesce("held", F.lit(0)))
    shifted = ~corrupt & F.coalesce(F.col("begins") != F.col("first"), F.lit(False))
    return out.select("file", "page_id", (F.col("first") + F.col("copy") * F.col("size")).alias("offset"), F.col("size").alias("length"), F.col("digest").alias("sha256"), "root", "replica_root", corrupt.alias("corrupt"), shifted.alias("shifted"))


def with_rot(pages: DataFrame) -> DataFrame:
    """A replica to audit: some pages lose their first or last character, by page id."""
    damaged = F.when(F.col("page_id") % 97 == 5, F.concat(F.lit("~"), F.expr("substring(html, 2)"))).when(F.col("page_id") % 193 == 7, F.expr("left(html, length(html) - 1)")).otherwise(F.col("html"))
    return pages.select("page_id", "url", damaged.alias("html"))


AUDIT_SQL = r"""
WITH sides AS (
    SELECT 0 AS side, page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
    UNION ALL
    SELECT 1, page_id, coalesce(url, ''), coalesce(CASE WHEN page_id % 97 = 5 THEN '~' || substr(html, 2)
        WHEN page_id % 193 = 7 THEN substr(html, 1, length(html) - 1) ELSE html END, '') FROM pages),
records AS (
    SELECT side, page_id, floor(page_id / 256.0)::BIGINT AS file,
           'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
           || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record
    FROM sides),
leaves AS (
    SELECT side, page_id, file, page_id % 256 AS node, sum(strlen(record)) OVER (PARTITION BY side, file ORDER BY page_id)::BIGINT AS last,
           strlen(record) AS length, sha256(record) AS digest
    FROM records),
slots AS (SELECT *, sha256(page_id || ':' || digest || ':' || length || ':1') AS d FROM leaves),
ranged AS (SELECT *, sum(length) OVER (PARTITION BY side, file, node // 16 ORDER BY node)::BIGINT AS upto FROM slots),
one AS (
    SELECT side, file, node // 16 AS node, sum(length)::BIGINT AS length,
           sha256(string_agg(node || ':' || (upto - length) || ':' || upto || ':' || d, ',' ORDER BY node)) AS d
    FROM ranged GROUP BY side, file, node // 16),
ranges AS (SELECT *, sum(length) OVER (PARTITION BY side, file ORDER BY node)::BIGINT AS upto FROM one),
two AS (SELECT side, file, sha256(string_agg(node || ':' || (upto - length) || ':' || upto || ':' || d, ',' ORDER BY node)) AS d FROM ranges GROUP BY side, file)
SELECT a.file, a.page_id, (a.last - a.length)::BIGINT AS "offset", a.length::BIGINT AS length, a.digest AS sha256, ra.d AS root, rb.d AS replica_root,
       a.digest <> b.digest AS corrupt, a.digest = b.digest AND a.last <> b.last AS shifted
FROM leaves a JOIN leaves b ON b.side = 1 AND a.page_id = b.page_id
JOIN two ra ON ra.side = 0 AND ra.file = a.file JOIN two rb ON rb.side = 1 AND rb.file = a.file
WHERE a.side = 0
"""
