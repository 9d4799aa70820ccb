"""Paged REST source (S5) with a user pagination rule.

A request is one row (ticker, load date, parameters); its page chain is
walked by one task, requests run in parallel, and a failed task is retried
by Spark.  The source is a Python Data Source (:func:`page_source`); it
returns the pages as they came, one row each, as soon as they are fetched:
what they hold is decoded by :mod:`lakebars.operators.pages`.

``fetch(params)`` returns a page (text, or a parsed object), and
``advance(page, params)`` says how many records it has and which request
follows; both are injected.
"""

from __future__ import annotations

import datetime
import json
import random
import sys
import time
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakebars.session import hadoop_path, new_run_dir

PAGE_SCHEMA = "ticker string, load_date date, request_start bigint, page string"
#: HTTP statuses after which a request is tried again.
RETRY_STATUSES = frozenset({429, 500, 502, 503, 504})


class PageError(RuntimeError):
    """A page that does not have the expected form, or a chain that does not advance."""


class FetchError(RuntimeError):
    """What a ``fetch`` raises for an HTTP error; ``retry_after`` in seconds if the server named it."""

    def __init__(self, message: str, status: int | None = None, retry_after: float | None = None):
        super().__init__(message)
        self.status, self.retry_after = status, retry_after


def with_retry(fetch: Callable[[dict], object], retries: int = 5, least_wait: float = 1.0, most_wait: float = 30.0,
               statuses=RETRY_STATUSES, sleep: Callable[[float], None] = time.sleep,
               jitter: Callable[[], float] = random.random) -> Callable[[dict], object]:
    """``fetch`` tried again after failures that may pass: lost connections, timeouts, ``statuses``.

    Waits double from ``least_wait`` to ``most_wait``, each shortened by up
    to a half at random so that tasks do not come back together; a server's
    ``Retry-After`` is waited for in full.
    """
    def run(params: dict):
        for attempt in range(retries + 1):
            try:
                return fetch(params)
            except (FetchError, OSError) as error:   # OSError: connections and timeouts
                status = getattr(error, "status", None)
                passing = not isinstance(error, FetchError) or status in statuses
                if not passing or attempt == retries:
                    raise
                named = getattr(error, "retry_after", None)
                wait = min(most_wait, least_wait * 2 ** attempt) * (1 - jitter() / 2)
            sleep(named if named is not None else wait)

    return run


def exchange_rows(page: str) -> int:
    """Records of an exchange page: the length of ``candles.data``; only an empty list ends a chain."""
    try:
        body = json.loads(page)
    except ValueError as error:
        raise PageError(f"page is no JSON: {page[:80]!r}") from error
    block = body.get("candles") if isinstance(body, dict) else None
    rows = block.get("data") if isinstance(block, dict) else None
    if not isinstance(rows, list) or not all(isinstance(r, list) for r in rows):
        raise PageError(f"page without a list of records: {page[:80]!r}")
    return len(rows)


def advance_by_rows(count: Callable[[str], int] = exchange_rows):
    """E1 for offset paging: the next request starts after the records received; an empty page ends the chain."""
    def advance(page: str, params: dict) -> tuple[int, dict | None]:
        n = count(page)
        return n, {**params, "start": int(params.get("start") or 0) + n} if n else None

    return advance


def single_page(page: str, params: dict) -> tuple[int, dict | None]:
    """No pagination: whatever came is the only page; an empty list or no body has no records."""
    body = json.loads(page)
    return (len(body) if isinstance(body, list) else int(body is not None)), None


def page_chain(fetch: Callable[[dict], object], advance, params: dict,
               on_bad_page: str = "raise") -> Iterator[tuple[int, str]]:
    """``(request start, page text)`` of every page with records, until a page has none or no request follows.

    A malformed page raises, so that Spark retries the task instead of
    losing the rest of the chain; ``on_bad_page="stop"`` ends the chain there.
    A request that repeats the one before raises: the chain would not end.
    """
    if on_bad_page not in ("raise", "stop"):
        raise ValueError(f"unknown on_bad_page={on_bad_page!r}")
    request = dict(params)
    while True:
        body = fetch(request)
        page = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False)
        try:
            records, following = advance(page, request)
        except PageError:
            if on_bad_page == "stop":
                return
            raise
        if records:
            yield int(request.get("start") or 0), page
        if not records or following is None:
            return
        if following == request:
            raise PageError(f"paging does not advance after {request}")
        request = following


def chunked(items: list, parts: int) -> list[list]:
    """``items`` dealt over at most ``parts`` lists, none empty."""
    return [items[k::parts] for k in range(min(parts, len(items)))]


def page_source(name: str, fetch: Callable[[dict], object], advance=None, on_bad_page: str = "raise",
                push_filters: bool = False) -> type:
    """S5 as a Python Data Source called ``name``: the pages of its requests as rows of :data:`PAGE_SCHEMA`.

    Options: ``requests``, a JSON list of objects (ticker, load_date and
    optionally params, an object of request parameters), or ``requestsPath``,
    a folder of Parquet files with these columns (params as JSON text), which
    is never read as a whole; ``partitions``, how many tasks walk chains at
    a time at most (of ``requests``; a file of ``requestsPath`` is a task).
    With ``push_filters``, equality and IN filters on ticker and load date
    leave out whole requests before they are made; Spark allows that only
    while ``spark.sql.python.filterPushdown.enabled`` is on.
    """
    from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

    rule = advance or advance_by_rows()

    class Requests(InputPartition):
        def __init__(self, rows=None, file=None):
            self.rows, self.file = rows, file

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options, self.wanted = dict(options), {}

        def _chosen(self, rows):
            return [r for r in rows if all(str(r[column]) in values for column, values in self.wanted.items())]

        def partitions(self):
            if "requestspath" in self.options:
                from pyarrow import fs

                store, root = fs.FileSystem.from_uri(self.options["requestspath"])
                found = store.get_file_info(fs.FileSelector(root))
                return [Requests(file=f.path) for f in sorted(found, key=lambda f: f.path)
                        if f.path.endswith(".parquet") and f.size] or [Requests(rows=[])]
            rows = self._chosen(json.loads(self.options.get("requests", "[]")))
            return [Requests(rows=part) for part in chunked(rows, int(self.options.get("partitions", len(rows) or 1)))] or [
                Requests(rows=[])]

        def _rows(self, partition):
            if partition.file is None:
                yield from partition.rows
                return
            import pyarrow.parquet as pq
            from pyarrow import fs

            store, _ = fs.FileSystem.from_uri(self.options["requestspath"])
            with store.open_input_file(partition.file) as source:
                for batch in pq.ParquetFile(source).iter_batches(1024):
                    for r in self._chosen(batch.to_pylist()):
                        yield {**r, "params": json.loads(r.get("params") or "{}")}

        def read(self, partition):
            for r in self._rows(partition):
                ticker, day = r["ticker"], datetime.date.fromisoformat(str(r["load_date"]))
                params = {**(r.get("params") or {}), "ticker": ticker, "date": str(day)}
                for start, page in page_chain(fetch, rule, params, on_bad_page):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ticker], pa.string()), pa.array([day], pa.date32()), pa.array([start], pa.int64()),
                         pa.array([page], pa.string())], ["ticker", "load_date", "request_start", "page"])

    class PushingReader(Reader):
        def pushFilters(self, filters):
            for f in filters:
                column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
                if column in ("ticker", "load_date"):
                    values = {str(v) for v in (f.value if isinstance(f, In) else [f.value])}
                    self.wanted[column] = self.wanted.get(column, values) & values
                else:
                    yield f

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return PAGE_SCHEMA

        def reader(self, schema):
            return (PushingReader if push_filters else Reader)(self.options)

    return Pages


def register_page_source(spark: SparkSession, name: str, fetch: Callable[[dict], object], advance=None,
                         on_bad_page: str = "raise") -> str:
    """``spark.read.format(name)`` reads pages through ``fetch`` from now on (see :func:`page_source`).

    Filters are pushed if the session allows it at this time.
    """
    from pyspark import cloudpickle

    # Ship this module by value: workers need neither the package nor the driver's path.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    spark.dataSource.register(page_source(name, fetch, advance, on_bad_page, push))
    return name


def write_requests(requests: DataFrame, path: str, parallelism: int | None = None) -> str:
    """``requests(ticker, load_date[, params])`` as the Parquet files of ``requestsPath``, one for each task."""
    width = parallelism or requests.sparkSession.sparkContext.defaultParallelism
    if "params" not in requests.columns:
        requests = requests.selectExpr("*", "CAST(NULL AS STRING) AS params")
    (requests.selectExpr("ticker", "CAST(load_date AS STRING) AS load_date", "params").repartition(width)
     .write.mode("overwrite").parquet(path))
    return path


def read_pages(requests: DataFrame, fetch: Callable[[dict], object], advance=None, parallelism: int | None = None,
               on_bad_page: str = "raise", path: str | None = None, name: str = "lakebars_pages") -> DataFrame:
    """All pages of ``requests(ticker, load_date[, params])``; ``params`` is a JSON object for that request.

    Every request carries its own parameters, with ``ticker`` and ``date``
    added.  The requests are written to ``path`` (a folder of the shared work
    folder by default), from which the source's tasks read them;
    ``parallelism`` is the number of tasks (the cores of the session by
    default).  The folder may go when the pages have been read.
    """
    spark = requests.sparkSession
    folder = write_requests(requests, path or new_run_dir(spark, "requests"), parallelism)
    register_page_source(spark, name, fetch, advance, on_bad_page)
    return spark.read.format(name).option("requestsPath", uri(spark, folder)).load()


def uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the session's file systems resolve it."""
    fs, p = hadoop_path(spark, path)
    full = fs.makeQualified(p).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full
