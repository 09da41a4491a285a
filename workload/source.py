"""A paged source over records that Spark wrote: what the registered queries extract from."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from itertools import accumulate

import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window, functions as F

from tidemark import ENVELOPE_KEY
from tidemark.session import CODEC, shuffles_deleted, small_shuffles
from tidemark.sources.paging import file_place

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Bytes of a row group: what a request for a page, or for a single record, has to read.
_GROUP_BYTES = 1 << 18


def land_source(rows: DataFrame, path: str, by: list[str], render: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write records ``(value, refresh)`` in a total order; a later path under the same folder takes over.

    With ``render``, rows are sorted as they are and rendered to records where they are written, once. Row groups are small, and beside
    the records stands which positions and refreshes each file holds, so that a page is found without opening the other
    files. A record's position is that of its file's first record and its place in the file.
    """
    in_order = rows.orderBy(*by)
    kept = (render(in_order) if render else in_order).select(F.unix_micros("refresh").alias("refresh"), "value")
    # Texts are only carried along: their bounds would be most of a footer, and no two are equal.
    options = {"parquet.block.size": str(_GROUP_BYTES), "parquet.column.statistics.enabled#value": "false", "parquet.enable.dictionary#value": "false"}
    with small_shuffles(rows.sparkSession), shuffles_deleted(rows.sparkSession):
        kept.write.options(compression=CODEC, **options).parquet(f"{path}/rows")
    kept = rows.sparkSession.read.schema("refresh long").parquet(f"{path}/rows")
    held = kept.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.count("refresh").alias("known"), F.min("refresh").alias("oldest"), F.max("refresh").alias("latest")
    )
    # One short row per file.
    until = F.sum("n").over(Window.orderBy(file_place(F.col("file"))))
    held = held.withColumns({"first": until - F.col("n"), "last": until - 1})
    held.coalesce(1).write.parquet(f"{path}/held")


@dataclass(frozen=True)
class Held:
    """A file of records: its positions, how many refreshes it has and knows, and the ends of these."""

    file: str
    first: int
    last: int
    n: int
    known: int
    oldest: int | None
    latest: int | None


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@lru_cache(maxsize=4)
def _held(path: str) -> list[Held]:
    """The files of a state, by their first position."""
    system, place = _system(f"{path}/held")
    rows = ds.dataset([f.path for f in system.get_file_info(fs.FileSelector(place)) if f.path.endswith(".parquet")], filesystem=system)
    return sorted((Held(**r) for r in rows.to_table().to_pylist()), key=lambda h: h.first)


@lru_cache(maxsize=8)
def _records(path: str, file: str) -> tuple[pq.ParquetFile, list[int]]:
    """A file and where its row groups begin, its end included."""
    system, place = _system(f"{path}/rows/{file}")
    opened = pq.ParquetFile(place, filesystem=system)
    sizes = (opened.metadata.row_group(k).num_rows for k in range(opened.num_row_groups))
    return opened, [0, *accumulate(sizes)]


def _values(path: str, file: str, first: int, end: int) -> list[str]:
    """Records of a file by their places. Only the row groups that hold them are read."""
    opened, starts = _records(path, file)
    groups = [k for k in range(opened.num_row_groups) if starts[k] < end and starts[k + 1] > first]
    column = opened.read_row_groups(groups, columns=["value"], use_threads=False).column("value")
    return column.slice(first - starts[groups[0]], end - first).to_pylist()


@lru_cache(maxsize=16)
def _before(path: str, instant: int) -> int:
    """Records refreshed before an instant, or unknown when. Only files that lie on both sides of it are looked into."""
    refresh, n = pc.field("refresh"), 0
    for held in _held(path):
        if held.latest is None or held.latest < instant:
            n += held.n
        elif held.oldest >= instant:
            n += held.n - held.known
        else:
            system, place = _system(f"{path}/rows/{held.file}")
            rows = ds.dataset([place], filesystem=system, format="parquet")
            n += rows.count_rows(filter=refresh.is_null() | (refresh < instant), use_threads=False)
    return n


def _newest(folder: str) -> str:
    system, place = _system(folder)
    states = sorted((i.base_name for i in system.get_file_info(fs.FileSelector(place)) if i.type == fs.FileType.Directory), reverse=True)
    done = (s for s in states if system.get_file_info(f"{place}/{s}/held/_SUCCESS").type == fs.FileType.File)
    return f"{folder}/{next(done)}"


@dataclass(frozen=True)
class FolderClient:
    """Pages of the newest state under a folder, as a remote source would give them."""

    folder: str

    def fetch(self, skip: int, top: int, since: str | None) -> str:
        path = _newest(self.folder)
        first = skip
        if since is not None:
            first += _before(path, (datetime.fromisoformat(since) - _EPOCH) // timedelta(microseconds=1))
        found: list[str] = []
        for held in _held(path):
            begin, end = max(first, held.first), min(first + top, held.last + 1)
            if begin < end:
                found += _values(path, held.file, begin - held.first, end - held.first)
        return f'{{"{ENVELOPE_KEY}":[{",".join(found)}]}}'
