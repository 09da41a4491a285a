"""A paged remote source as a data source of Spark's own: ``spark.read.format(name)`` and ``spark.readStream.format(name)``.

The client knows how to ask for a page. Offset ranges of the source are partitions, each fetched by its own task, which asks
again a few times before it fails and Spark gives it to another executor. Where the source ends is
found by a few requests for single records, at offsets that double and then halve.

    register_source(spark, "projects", client)
    pages = spark.read.format("projects").option("since", "2024-01-15T00:00:00Z").load()
    records = unwrap(pages)

Options: ``top`` records a page, ``pages_per_task`` (a multiple of it beyond ``MOST_TASKS`` tasks), ``since`` (records refreshed then or later), ``attempts`` a request,
``pause`` (seconds before the second attempt, doubled for each further one), ``key`` of the records in a page.
"""

import json
import random
import time
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.schema import ENVELOPE_KEY, PAGE_CAP
from tidemark.sources.paging import page_size

SCHEMA = "page_seq long, value string"

LONGEST_PAUSE = 60.0

# Tasks of one read. Each costs a Python worker some hundredths of a second before its first request, more than a short range takes.
MOST_TASKS = 512


class Client(Protocol):
    """Asks for pages. It runs on executors, so it must be picklable, and a lost task repeats its requests."""

    def fetch(self, skip: int, top: int, since: str | None) -> str:
        """The body of one page: records in order of refresh, unknown ones first; with ``since``, those refreshed then or later."""


@dataclass(frozen=True)
class Settings:
    top: int = PAGE_CAP
    pages_per_task: int = 16
    attempts: int = 5
    pause: float = 1.0
    since: str | None = None
    key: str = ENVELOPE_KEY
    refresh: str = "lastRefresh"

    @classmethod
    def of(cls, options) -> "Settings":
        texts = {k: options.get(k.replace("_", "")) or options.get(k) for k in cls.__dataclass_fields__}
        kinds = {"top": int, "pages_per_task": int, "attempts": int, "pause": float}
        given = cls(**{k: kinds.get(k, str)(v) for k, v in texts.items() if v})
        page_size(given.top)
        return given


@dataclass
class Range(InputPartition):
    """Records ``first`` to ``end`` of those since an instant; without an end, to the first short page."""

    first: int
    end: int | None
    since: str | None


class Requests:
    """Requests of one client, asked again after failures."""

    def __init__(self, client: Client, settings: Settings):
        self.client, self.settings = client, settings

    def body(self, skip: int, top: int, since: str | None) -> str:
        for attempt in range(1, self.settings.attempts + 1):
            try:
                return self.client.fetch(skip, top, since)
            except OSError:
                if attempt == self.settings.attempts:
                    raise
                time.sleep(min(LONGEST_PAUSE, self.settings.pause * 2 ** (attempt - 1) * (1 + random.random() / 2)))
        raise ValueError("at least one attempt is needed")

    def records(self, body: str) -> list:
        page = json.loads(body)
        found = page if isinstance(page, list) else page.get(self.settings.key)
        return found if isinstance(found, list) else []

    def one(self, at: int, since: str | None) -> dict | None:
        return next(iter(self.records(self.body(at, 1, since))), None)

    def count(self, since: str | None) -> int:
        """How many records there are: the first offset without one."""
        if self.one(0, since) is None:
            return 0
        there, past = 0, 1
        while self.one(past, since) is not None:
            there, past = past, 2 * past
        while past - there > 1:
            middle = (there + past) // 2
            there, past = (middle, past) if self.one(middle, since) is not None else (there, middle)
        return past

    def ranges(self, n: int, since: str | None, open_end: bool) -> list[Range]:
        """Whole pages, some for each task."""
        step = self.settings.top * self.settings.pages_per_task
        step *= max(1, -(-n // (step * MOST_TASKS)))
        out = [Range(a, min(a + step, n), since) for a in range(0, n, step)]
        if open_end:
            out = [*out[:-1], Range(out[-1].first if out else 0, None, since)]
        return out

    def pages(self, part: Range) -> Iterator[pa.RecordBatch]:
        at = part.first
        while part.end is None or at < part.end:
            top = self.settings.top if part.end is None else min(self.settings.top, part.end - at)
            body = self.body(at, top, part.since)
            found = len(self.records(body))
            if found:
                yield pa.RecordBatch.from_pydict({"page_seq": [at // self.settings.top], "value": [body]})
            if found < top:
                return
            at += top


class PagedReader(DataSourceReader):
    """All records, or those since an instant."""

    def __init__(self, requests: Requests):
        self.requests = requests

    def partitions(self) -> list[Range]:
        since = self.requests.settings.since
        return self.requests.ranges(self.requests.count(since), since, open_end=True)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.requests.pages(partition)


class PagedStreamReader(DataSourceStreamReader):
    """What is refreshed as time goes on.

    An offset is the latest refresh in the source and the number of records that have it, so it says by itself how far
    a batch goes: a restarted query needs nothing but its checkpoint, and a batch that failed is planned again from the same two offsets.
    Batches begin with the records at the start's refresh, which are read twice, as an upsert allows. A record that is refreshed
    while its batch is read moves to the end, and the next batch has it; the source must not lose its neighbours meanwhile.
    """

    def __init__(self, requests: Requests):
        self.requests = requests
        self.since = requests.settings.since

    def initialOffset(self) -> dict:
        return {"since": self.requests.settings.since or "", "skip": 0}

    def latestOffset(self) -> dict:
        n = self.requests.count(self.since)
        if not n:
            return {"since": self.since or "", "skip": 0}
        latest = self.requests.one(n - 1, self.since)
        refresh = (latest or {}).get(self.requests.settings.refresh)
        if not refresh:
            return {"since": self.since or "", "skip": n}
        if refresh != self.since:
            self.since = refresh
            n = self.requests.count(refresh)
        return {"since": refresh, "skip": n}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        if start == end:
            return []
        since = start["since"] or None
        n = end["skip"]
        if end["since"] != start["since"]:
            n += self.requests.count(since) - self.requests.count(end["since"])
        return self.requests.ranges(n, since, open_end=False)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.requests.pages(partition)

    def commit(self, end: dict) -> None:
        self.since = end["since"] or None


def paged_source(name: str, client: Client) -> type[DataSource]:
    """A data source class for one client. It is made here, so that it travels to executors with its client."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(Requests(client, Settings.of(self.options)))

        def streamReader(self, schema) -> DataSourceStreamReader:
            return PagedStreamReader(Requests(client, Settings.of(self.options)))

    return Paged


def register_source(spark: SparkSession, name: str, client: Client) -> None:
    """Make the client's pages readable as format ``name``. Python workers import this package from where the driver has it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.dataSource.register(paged_source(name, client))
