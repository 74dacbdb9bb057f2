"""Records of one large JSON array, read by byte ranges.

A bundle is one JSON object whose fields are arrays of records.  A record begins
where ``}, {"`` is followed by a key, and that can be told from the bytes around
it: inside a string an unescaped quote would end the string, after which only
white space and one of ``, : ] }`` may follow, and keys here don't begin with any
of these.  So a file of any size is read by many tasks, each from the first
record that begins in its range, without anyone reading what lies before.

Two steps: one job over the ranges finds where the wanted array begins and ends;
the data source ``json_array`` then reads it, with filters by equality and by
lists of values tested on a record's bytes before it is parsed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StringType, StructType

SPLIT_BYTES = 32 << 20
BATCH_ROWS = 2000
FILE_BITS = 42  # of ``ord``: the place in a file
SLACK = 4096  # the longest white space and key that may lie across the edge of two ranges
_S = rb"[\x20\t\r\n]*"
_KEY = rb"\"[^\"\x20\t\r\n,:\]}]"
_NEXT = re.compile(rb"\}" + _S + b"," + _S + rb"(?=\{" + _S + _KEY + b")")
_END = re.compile(rb"\}(?=" + _S + rb"\]" + _S + b"," + _S + _KEY + b")")
_LAST = re.compile(rb"\}(?=" + _S + rb"\]" + _S + rb"\}" + _S + rb"\Z)")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it: a local path, or a URI of file, hdfs, s3 or gs."""
    if re.match("[a-z0-9]+:/", path):
        return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def readable(path: str) -> bool:
    """Whether tasks can open the path themselves; a store that only Spark's own readers know is not."""
    return not re.match("[a-z0-9]+:/", path) or path.split(":")[0] in ("file", "hdfs", "s3", "gs")


def files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the data files of a folder."""
    system, name = opened(path)
    info = system.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    inside = system.get_file_info(fs.FileSelector(name))
    return sorted((f"{path.rstrip('/')}/{x.base_name}", x.size) for x in inside if x.type == fs.FileType.File and x.size and x.base_name[0] not in "._")


def marks(data: bytes, whole: bool, field: str) -> Iterator[tuple[str, int, int]]:
    """(kind, place, offset) of where arrays begin and end in some bytes: of the array ``field``, offset is that of its first record; of any, the end of its last record.  ``whole``: the bytes reach the file's end."""
    begin = re.compile(rb"\"" + re.escape(json.dumps(field, ensure_ascii=False).encode()[1:-1]) + rb"\"" + _S + b":" + _S + rb"\[(?=" + _S + rb"\{)")
    for kind, form in (("begin", begin), ("end", _END), *((("end", _LAST),) if whole else ())):
        for m in form.finditer(data):
            yield kind, m.start(), m.end()


def extents(spark: SparkSession, path: str, fields: list[str], split: int = SPLIT_BYTES) -> dict[str, list[tuple[str, int, int]]]:
    """For each field, (file, begin, end) of its array in each file that has one with records, found by one job over the byte ranges."""
    sized = files(path)
    ranges = [(name, low, size) for name, size in sized for low in range(0, size, split)]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, low, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, inside = opened(name)
                high = min(size, low + split + SLACK)
                with system.open_input_file(inside) as file:
                    data = file.read_at(high - low, low)
                found = {(k, f if k == "begin" else "", low + at) for f in fields for k, place, at in marks(data, high == size, f) if place < split}
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), *(pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64())))], names=["file", "kind", "field", "at"])

    rows = spark.createDataFrame(ranges, "file string, low long, size long").repartition(max(1, len(ranges)), "file", "low")
    found = rows.mapInArrow(look, "file string, kind string, field string, at long").collect()  # a row for each array, of which a bundle has some ten
    out: dict[str, list[tuple[str, int, int]]] = {f: [] for f in fields}
    for name, size in sized:
        ends = sorted(r["at"] for r in found if r.file == name and r.kind == "end")
        for f in fields:
            if begins := [r["at"] for r in found if r.file == name and r.field == f and r.kind == "begin"]:
                out[f].append((name, min(begins), next((e for e in ends if e > min(begins)), size)))
    return out


def records(path: str, begin: int, end: int, low: int, high: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the records that begin in [low, high) of the array whose records lie in [begin, end)."""
    system, name = opened(path)
    with system.open_input_file(name) as file:
        base = max(begin, low - SLACK)
        data = file.read_at(min(end, high + SLACK) - base, base)
        starts = [(begin, begin)] if low <= begin else []  # (where the record before ends, where this one begins)
        tried = 0
        while True:
            for m in _NEXT.finditer(data, tried):
                if base + m.end() >= low:
                    starts.append((base + m.start() + 1, base + m.end()))
                    if starts[-1][1] >= high:
                        break
            reached = base + len(data)
            if reached >= end or (starts and starts[-1][1] >= high) or (not starts and reached >= high + SLACK):
                break
            tried = max(0, len(data) - SLACK)
            if starts:
                tried = max(tried, starts[-1][1] - base)
            data += file.read_at(min(end - reached, SPLIT_BYTES), reached)  # the last record goes on
    for k, (_, start) in enumerate(starts):
        if start < high:
            yield start, data[start - base : (starts[k + 1][0] if k + 1 < len(starts) else end) - base]


def cell(value: object) -> str | None:
    """A field as text: strings as they are, numbers as written, others as JSON."""
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int
    low: int
    high: int
    file: int


class JsonArrayReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        if any(f.name != "ord" and not isinstance(f.dataType, StringType) for f in schema.fields):
            raise ValueError("columns are strings, but for ord")
        self.names = [f.name for f in schema.fields]
        self.extent = json.loads(options["extent"])
        self.split = int(options["split"])
        self.wanted: dict[str, frozenset[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = f.value if isinstance(f, In) else (f.value,) if isinstance(f, EqualTo) else None
            if values is None or len(f.attribute) != 1 or f.attribute[0] == "ord" or f.attribute[0] in self.wanted:
                yield f
            else:
                self.wanted[f.attribute[0]] = frozenset(x for x in values if x is not None)

    def partitions(self) -> list[Range]:
        return [Range(path, begin, end, low, min(end, low + self.split), k) for k, (path, begin, end) in enumerate(self.extent) for low in range(begin, end, self.split)]

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # there are no partitions
            return
        schema = pa.schema([(n, pa.int64() if n == "ord" else pa.string()) for n in self.names])
        quick = [(re.compile(rb"(?<!\\)\"" + re.escape(n.encode()) + rb"\"" + _S + b":" + _S + rb"\"([^\"]*)\""), {x.encode() for x in values}) for n, values in self.wanted.items()]

        def rows() -> Iterator[tuple]:
            for at, data in records(part.path, part.begin, part.end, part.low, part.high):
                if any(len(told := form.findall(data)) == 1 and told[0] not in values for form, values in quick):
                    continue
                record = json.loads(data, parse_int=str, parse_float=str, parse_constant=str)
                if all(cell(record.get(n)) in values for n, values in self.wanted.items()):
                    yield tuple((part.file << FILE_BITS) + at if n == "ord" else cell(record.get(n)) for n in self.names)

        found = rows()
        while held := list(islice(found, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


class JsonArraySource(DataSource):
    """``json_array``: the records of an array whose place the option ``extent`` gives, as :func:`extents` finds it; ``split`` bytes a partition."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        raise ValueError("give a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return JsonArrayReader(schema, self.options)


def read_arrays(spark: SparkSession, path: str, columns: dict[str, list[str]], split: int = SPLIT_BYTES) -> list[DataFrame]:
    """The records of some arrays of a bundle (a file, or a folder of such files): for each field its columns as text, and ``ord``, ascending by file name and place.

    Fields that a record lacks are null, other fields are left out, and the last of
    repeated ones counts.  Records are objects without arrays of objects in them,
    whose first key doesn't begin with white space or one of ``, : ] }``.  A missing
    or empty array gives no rows; a record that isn't JSON is an error.
    """
    spark.dataSource.register(JsonArraySource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    found = extents(spark, path, list(columns), split)
    out = []
    for field, names in columns.items():
        schema = ", ".join([*(f"`{c}` string" for c in names), "ord long"])
        out.append(spark.read.format("json_array").schema(schema).options(extent=json.dumps(found[field]), split=split).load())
    return out
