"""Paged extract of a remote source: offset ranges are Spark tasks, pages are written as they come.

``fetch(skip, top)`` returns the body of one page. It runs on executors, so it must be picklable,
and a lost task repeats it, so it must be safe to call again.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schema import ENVELOPE_KEY, PAGE_CAP
from tidemark.sources.pages import unwrap
from tidemark.sources.paging import page_size

Fetch = Callable[[int, int], str]


def extract_pages(
    spark: SparkSession, fetch: Fetch, first_page: int, n_pages: int, top: int = PAGE_CAP, pages_per_task: int = 16
) -> DataFrame:
    """Pages ``first_page .. first_page + n_pages`` as ``(page_seq, value)``.

    Write the result before use: each evaluation fetches again.
    """
    size = page_size(top)

    def fetch_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seq in batch.column("page_seq").to_pylist():
                yield pa.RecordBatch.from_pydict({"page_seq": [seq], "value": [fetch(seq * size, size)]})

    tasks = max(1, -(-n_pages // pages_per_task))
    sequence = spark.range(first_page, first_page + n_pages, 1, tasks).select(F.col("id").alias("page_seq"))
    return sequence.mapInArrow(fetch_all, "page_seq long, value string")


def extract_waves(
    spark: SparkSession,
    wave_of: Callable[[int, int], DataFrame],
    path: str,
    top: int = PAGE_CAP,
    wave: int = 256,
    key: str = ENVELOPE_KEY,
) -> DataFrame:
    """Pages ``(page_seq, value)`` until a short, empty or missing one, without knowing the total.

    ``wave_of(first, n)`` gives some pages, which are written under ``path`` (new, and shared) before they
    are looked at; read them back as often as needed.
    """
    size, first = page_size(top), 0
    while True:
        folder = f"{path}/wave={first}"
        wave_of(first, wave).select("page_seq", "value").write.parquet(folder)
        per_page = unwrap(spark.read.schema("page_seq long, value string").parquet(folder), key).groupBy("ord.page_seq").count()
        if per_page.where(F.col("count") >= size).count() < wave:
            return spark.read.schema("page_seq long, value string, wave long").parquet(path).select("page_seq", "value")
        first += wave


def extract_all(
    spark: SparkSession, fetch: Fetch, path: str, top: int = PAGE_CAP, wave: int = 256, pages_per_task: int = 16
) -> DataFrame:
    """Every page of a remote source until a short or empty one: waves of pages, each in parallel."""
    return extract_waves(spark, lambda first, n: extract_pages(spark, fetch, first, n, top, pages_per_task), path, top, wave)
