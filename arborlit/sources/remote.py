"""Records and metrics from a remote service, through a fetcher that the caller gives.

Ids are dealt into batches; a batch is fetched with retries and back-off inside
a task.  Nothing here opens a connection itself.  What a service has answered
before can be given as a table instead (:func:`recorded_records`).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlit.operators.latest import batch_number
from arborlit.sources import schemas as S
from arborlit.sources.json_array import files, opened
from arborlit.sources.readers import WRAPPER, empty, exists, response_records

RETRIED = (429, 500, 502, 503, 504)


class FetchError(Exception):
    """A failed request: ``reason`` says why, ``retry`` whether another try may help."""

    def __init__(self, reason: str, retry: bool = True):
        super().__init__(reason)
        self.reason, self.retry = reason, retry

    @classmethod
    def http(cls, status: int) -> FetchError:
        return cls(f"http_{status}", status in RETRIED)


def attempt(fetch: Callable[[list[str]], str], ids: list[str], tries: int = 3, base: float = 2.0, wait: Callable[[float], None] = time.sleep) -> tuple[list[dict], str]:
    """The records of a batch, or none and a reason; empty and unreadable answers are tried again."""
    reason = "network_error"
    for k in range(1, tries + 1):
        retry = True
        try:
            raw = fetch(ids).strip()
            if raw:
                parsed = json.loads(raw)
                if isinstance(parsed, dict) and WRAPPER in parsed:
                    return parsed[WRAPPER] or [], ""
                return (parsed if isinstance(parsed, list) else [parsed] if isinstance(parsed, dict) else []), ""
            reason = "no_record"
        except FetchError as e:
            reason, retry = e.reason, e.retry
        except TimeoutError:
            reason = "timeout"
        except ValueError:
            reason = "parse_error"
        except Exception as e:  # any other failure is reported with the batch, not raised
            reason = f"network_error:{e}"
        if not retry:
            break
        if k < tries:
            wait(base**k)
    return [], reason


ANSWERED = "pmid string, raw string, reason string"


def _fetching(fetch: Callable[[list[str]], str], batch: int, tries: int, base: float, pause: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            wanted = frame["pmid"].tolist()
            for low in range(0, len(wanted), batch):
                part = wanted[low : low + batch]
                records, reason = attempt(fetch, part, tries, base)
                found = {str(r.get("pmid", r.get("id", ""))): json.dumps(r) for r in records if r}
                yield pd.DataFrame({"pmid": part, "raw": [found.get(x) for x in part], "reason": ["" if x in found else reason or "absent_from_response" for x in part]})
                if pause:
                    time.sleep(pause)

    return run


def fetch_records(ids: DataFrame, fetch: Callable[[list[str]], str], batch: int = 20, tasks: int | None = None, pause: float = 0.0, tries: int = 3, base: float = 2.0) -> DataFrame:
    """(pmid, record, reason) for each id; ``tasks`` (the session's shuffle partitions) bounds how many batches run at once.

    An id that the answer doesn't hold gets the batch's reason or ``absent_from_response``.
    """
    tasks = tasks or int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    got = ids.select("pmid").distinct().repartition(tasks).mapInPandas(_fetching(fetch, batch, tries, base, pause), ANSWERED)
    return got.select("pmid", F.from_json("raw", S.RECORD).alias("record"), "reason")


def fetch_into(log: str, ids: DataFrame, fetch: Callable[[list[str]], str], batch: int = 20, every: int = 10, pause: float = 0.0, tries: int = 3, base: float = 2.0) -> None:
    """Fetch the records of ``ids`` into the folder ``log``, where :func:`logged` finds them.

    One job has a task for each ``every`` batches, and a task's answers are in the
    folder as soon as it ends.  So a lost executor repeats its own unfinished tasks
    only, no batch waits for another's, and a run that breaks off leaves what it has
    fetched to the next.  Rows of two runs may both be there; either will do.
    """
    numbered = batch_number(ids.select("pmid").distinct(), batch * every, ["pmid"])
    tasks = numbered.agg(F.max("batch")).first()[0] or 0
    if not tasks:
        return
    got = numbered.repartitionByRange(tasks, "batch").select("pmid").mapInPandas(_fetching(fetch, batch, tries, base, pause), ANSWERED)
    # version 2 of Hadoop's committer moves a task's files to their place when the task commits, not when the job does
    got.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("compression", "gzip").json(log)


def logged(spark: SparkSession, log: str) -> DataFrame:
    """(pmid, record, reason) of what the folder holds: one row of each id, a record rather than a reason."""
    if not exists(spark, log):
        return empty(spark, f"pmid string, record {S.RECORD}, reason string")
    rows = spark.read.schema(ANSWERED).json(log).where("pmid is not null")
    best = rows.groupBy("pmid").agg(F.max_by(F.struct("raw", "reason"), F.struct(F.col("raw").isNotNull(), "raw", "reason")).alias("r"))
    return best.select("pmid", F.from_json("r.raw", S.RECORD).alias("record"), "r.reason")


def recorded_records(ids: DataFrame, responses: DataFrame) -> DataFrame:
    """(pmid, record, reason) for each id, as :func:`fetch_records` gives them, from answers that are on record.

    ``responses`` has request (a key), ids (asked for), status and body.  An id that
    no request asked for is ``absent_from_response``.
    """
    wanted = ids.select("pmid").distinct()
    asked = responses.select("request", F.explode("ids").alias("pmid"), "status", (F.trim(F.coalesce("body", F.lit(""))) == "").alias("blank")).join(wanted, "pmid", "left_semi")
    inside = responses.where("status = 200").select("request", F.explode(response_records(F.col("body"))).alias("record"))
    inside = inside.where("record is not null").select("request", F.coalesce("record.pmid", "record.id").alias("pmid"), "record")
    found = asked.join(inside, ["request", "pmid"], "left")
    reason = F.when(F.col("record").isNotNull(), "").when(F.col("status") != 200, F.concat(F.lit("http_"), F.col("status").cast("string"))).when(F.col("blank"), "no_record").otherwise("absent_from_response")
    best = found.groupBy("pmid").agg(F.max_by(F.struct("record", reason.alias("reason")), F.struct(F.col("record").isNotNull(), "request")).alias("r"))
    return wanted.join(best, "pmid", "left").select("pmid", "r.record", F.coalesce("r.reason", F.lit("absent_from_response")).alias("reason"))


def fetch_values(keys: DataFrame, fetch: Callable[[list[str]], dict], value: str, batch: int = 200, tasks: int | None = None) -> DataFrame:
    """(key, value) for the cache: ``fetch`` gives a dict by key, null for what is known to be absent; failed batches give no rows and are tried again on the next run."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            wanted = frame["key"].tolist()
            for low in range(0, len(wanted), batch):
                part = wanted[low : low + batch]
                try:
                    got = fetch(part)
                except FetchError:
                    continue
                yield pd.DataFrame({"key": part, "raw": [None if got.get(x) is None else json.dumps(got[x]) for x in part]})

    tasks = tasks or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keys.select("key").distinct().repartition(tasks).mapInPandas(run, "key string, raw string")
    return rows.select("key", F.from_json("raw", value).alias("value"))


def recorded_values(keys: DataFrame, answers: DataFrame, value: str) -> DataFrame:
    """(key, value) of the keys that ``answers`` (key, raw) has, as :func:`fetch_values` gives them; a null ``raw`` is known to be absent."""
    wanted = keys.select("key").distinct()
    return answers.join(wanted, "key", "left_semi").select("key", F.from_json("raw", value).alias("value"))


def file_chunks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a file, or of the data files of a folder, piece by piece."""
    for name, _ in files(path):
        system, inside = opened(name)
        with system.open_input_stream(inside) as file:
            while data := file.read(size):
                yield data


def fetched_file(spark: SparkSession, path: str, open_source: Callable[[], Iterator[bytes]], force: bool = False) -> str:
    """A reference file at ``path``, of any file system that Spark knows, fetched unless it is there; ``force`` fetches anew.

    The bytes go to a file beside it first, which takes the name when it is
    whole, so a fetch that breaks off leaves nothing behind that looks fetched.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    target, part = fs.Path(path), fs.Path(f"{path}.part")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target) and not force:
        return path
    out = system.create(part, True)
    try:
        for chunk in open_source():
            out.write(bytearray(chunk))
    finally:
        out.close()
    system.delete(target, True)
    system.rename(part, target)
    return path


def file_payload(message: str, branch: str, content: Column, sha: Column) -> Column:
    """The JSON body that puts a text file into a repository: base 64 of UTF-8, and the sha of what it replaces, if any."""
    body = F.struct(F.lit(message).alias("message"), F.base64(F.encode(content, "UTF-8")).alias("content"), F.lit(branch).alias("branch"), sha.alias("sha"))
    return F.to_json(body)


def recent_run(runs: DataFrame, since: Column, slack: int = 10, listed: int = 5) -> DataFrame:
    """The first of the ``listed`` first runs (created_at, ord, ...) that began no more than ``slack`` seconds before ``since``; no row if none did."""
    page = runs.orderBy("ord").limit(listed)
    return page.where(F.col("created_at") >= since - F.make_interval(secs=F.lit(slack))).orderBy("ord").limit(1)
