"""A paged record API as a Spark data source: one partition per page, as a batch or as a stream of what is new."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidymart.contracts import PAGE_SIZE, all_string

Fetch = Callable[[int, int], dict]


@dataclass(frozen=True)
class HttpFetcher:
    """Pages of ``base_url?resource_id=..&limit=..&offset=..``, with a few retries."""

    base_url: str
    resource_id: str
    attempts: int = 4
    timeout: float = 120.0

    def __call__(self, offset: int, limit: int) -> dict:
        query = urllib.parse.urlencode(
            {"resource_id": self.resource_id, "limit": limit, "offset": offset}
        )
        for attempt in range(1, self.attempts + 1):
            try:
                with urllib.request.urlopen(f"{self.base_url}?{query}", timeout=self.timeout) as answer:
                    return json.loads(answer.read().decode("utf-8"))
            except OSError:
                if attempt == self.attempts:
                    raise
                time.sleep(2.0**attempt)


@dataclass(frozen=True)
class FolderFetcher:
    """Saved answers, one text file in ``offset=<n>`` per page, in a folder the executors share."""

    folder: str

    def __call__(self, offset: int, limit: int) -> dict:
        store, base = fs.FileSystem.from_uri(self.folder)
        files = store.get_file_info(fs.FileSelector(f"{base}/offset={offset}"))
        parts = [f.path for f in files if f.base_name.startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"{len(parts)} saved answers for offset {offset}, one is expected")
        with store.open_input_stream(parts[0], compression=None) as answer:
            return json.loads(answer.read().decode("utf-8"))


def checked(answer: dict) -> dict:
    if not answer.get("success"):
        raise RuntimeError("the API returned an error")
    return answer.get("result") or {}


@dataclass(frozen=True)
class Extent:
    """What the first answer tells of a source: how many records it has, and their columns."""

    total: int
    columns: tuple[str, ...]


def extent(fetch: Fetch, limit: int) -> Extent:
    """The first page is read here for the total and the columns; its records are fetched again by the task of that page."""
    first = checked(fetch(0, limit))
    records = first.get("records") or []
    return Extent(int(first.get("total") or len(records)), tuple(records[0] if records else ()))


@dataclass
class Page(InputPartition):
    """Where a page begins, how many records it must have, and how many of them were taken before."""

    offset: int
    expected: int
    skip: int = 0


def page_list(start: int, end: int, limit: int) -> list[Page]:
    """The pages that hold the records from `start` up to `end`; all begin at a multiple of `limit`."""
    return [Page(o, min(limit, end - o), max(0, start - o)) for o in range(start - start % limit, end, limit)]


def read_page(fetch: Fetch, limit: int, columns: list[str], page: Page) -> Iterator[pa.RecordBatch]:
    """The records of a page as text: where a server answers with fewer than expected, it is asked for the rest."""
    records: list = []
    while len(records) < page.expected:
        start = page.offset + len(records)
        more = checked(fetch(start, limit)).get("records") or []
        if not more:
            raise RuntimeError(f"no records from offset {start}, but the total promises more")
        records += more
    records = records[page.skip : page.expected]
    if records:
        cells = [
            pa.array([None if r.get(c) is None else str(r[c]) for r in records], pa.string()) for c in columns
        ]
        yield pa.RecordBatch.from_arrays(cells, names=columns)


class PagedReader(DataSourceReader):
    def __init__(self, fetch: Fetch, limit: int, columns: list[str], total: int):
        self.fetch, self.limit, self.columns, self.total = fetch, limit, columns, total

    def partitions(self) -> list[Page]:
        return page_list(0, self.total, self.limit) or [Page(0, 0)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        return read_page(self.fetch, self.limit, self.columns, partition)


class PagedStreamReader(DataSourceStreamReader):
    """Records of a source that only grows at its end; an offset is the number of records before it.

    Spark keeps the offsets in the checkpoint of the query, so a restart goes on behind the last batch
    that was committed, and a batch that failed is read again with the same ends.
    """

    def __init__(self, fetch: Fetch, limit: int, columns: list[str]):
        self.fetch, self.limit, self.columns = fetch, limit, columns

    def initialOffset(self) -> dict:
        return {"records": 0}

    def latestOffset(self) -> dict:
        return {"records": extent(self.fetch, self.limit).total}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        if end["records"] < start["records"]:
            raise RuntimeError(f"the source has {end['records']} records, {start['records']} were read before")
        return page_list(start["records"], end["records"], self.limit)

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        return read_page(self.fetch, self.limit, self.columns, partition)


def paged_source(fetch: Fetch, name: str = "paged_records", known: Extent | None = None) -> type[DataSource]:
    """A data source that reads through ``fetch(offset, limit)``; the option ``limit`` is the page size.

    ``known`` saves asking for the total and the columns where they are known already; no records travel with
    the source. As a stream it reads what was added since the last batch.
    """

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def _limit(self) -> int:
            return int(self.options.get("limit", PAGE_SIZE))

        def _extent(self) -> Extent:
            return known if known is not None else extent(fetch, self._limit())

        def schema(self) -> StructType:
            """Columns of the first record, all text."""
            return all_string(self._extent().columns)

        def reader(self, schema: StructType) -> DataSourceReader:
            return PagedReader(fetch, self._limit(), schema.fieldNames(), self._extent().total)

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return PagedStreamReader(fetch, self._limit(), schema.fieldNames())

    return PagedSource


def read_pages(spark: SparkSession, fetch: Fetch, limit: int = PAGE_SIZE, columns=None):
    """Every record of every page; each page is fetched by its own task."""
    source = paged_source(fetch, known=extent(fetch, limit))
    spark.dataSource.register(source)
    reader = spark.read.format(source.name()).option("limit", limit)
    if columns is not None:
        reader = reader.schema(all_string(columns))
    return reader.load()


def extract_new(
    spark: SparkSession,
    fetch: Fetch,
    target: str,
    checkpoint: str,
    columns: Sequence[str],
    limit: int = PAGE_SIZE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Add to the Parquet table `target` the records that the source has gained since the last run with this checkpoint.

    The source must keep its order and grow at the end; one that has shrunk fails the run. Only the new
    part is fetched, a page by a task; of the page in which the last run ended the known records are dropped. The
    file sink logs each batch, so a batch that is repeated after a failure adds nothing twice. Read the table
    with Spark, which heeds that log.
    """
    source = paged_source(fetch, "paged_stream", known=Extent(0, tuple(columns)))
    spark.dataSource.register(source)
    rows = spark.readStream.format(source.name()).option("limit", limit).schema(all_string(columns)).load()
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(target)
