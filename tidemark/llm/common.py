"""Shared parts: session set-up, row keys, written steps, and words and hashes of whole Arrow batches."""

import ctypes
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import prepare
from tidemark.session import written

ROOT = str(Path(__file__).resolve().parents[2])

SETTINGS = {
    # Batches that cross to Python hold whole texts: bound them by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Shuffle files of a finished job go at its end, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

#: Bytes of text that numpy works on at a time; a longer text makes a slice of its own.
SLICE = 2 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Apply the settings and let Python workers import this package from where the driver has it."""
    prepare(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have a place in input files, else a written copy that has. Steps that join by row share one."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return written(docs, "rows")
    return docs


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``(row_file, row_at, *columns)``: a key of each row that no second pass changes.

    It is the place in the input files; rows that come from no file raise, and go through ``placed`` once before.
    ``doc_id`` serves as no key, for rows may repeat.
    """
    return docs.select(F.xxhash64("_metadata.file_path").alias("row_file"), F.col("_metadata.row_index").alias("row_at"), *columns)


#: Bytes of text whose hashes meet in one group of a shuffle; what a group takes in memory is some ten times as much.
GROUP = 6 << 20


def groups_for(docs: DataFrame, *sizes: int) -> list[int]:
    """How many groups of at most so many bytes of text all texts make, each time no fewer than the session has partitions."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return [max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size)) for size in sizes]


def texts_of(column) -> tuple[np.ndarray, np.ndarray]:
    """A text column as ``(bytes, offsets)``; NULL is empty. Sixteen zero bytes follow the last text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(int(offsets[-1] - offsets[0]) + 16, np.uint8)
    if column.buffers()[2] is not None:
        data[:-16] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def release() -> None:
    """Give memory that a task has freed back to the system; workers live on, and executors are counted with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freeing(f: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function of a group that gives back the memory it took once it is done."""

    def run(group: pa.Table) -> pa.Table:
        out = f(group)
        release()
        return out

    return run


def releasing(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of a task's batches that gives back the memory it took once it is done, and what it held last has gone too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        release()

    return run


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece have at most ``limit`` bytes, or are one text."""
    release()
    try:
        yield from _sliced(batches, column, limit)
    finally:
        release()


def _sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that white space ends (space and \x09 to \x0D), and of words of digits, a to z and non-ASCII.
PRINTED = np.ones(256, bool)
PRINTED[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes within each text: ``(starts, ends, first run of each text and the total)``."""
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]
    starts[edge] = inside[edge]
    edge = offsets[1:][np.diff(offsets) > 0] - 1
    ends[edge] = inside[edge]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte slices, eight bytes of every slice at a time. ``data`` needs 8 spare bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    sizes = (ends - starts).astype(np.int64)
    out = mixed(sizes.astype(np.uint64) + np.uint64((seed * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    left = np.flatnonzero(sizes > 0)
    at = 0
    while len(left):
        rest = sizes[left] - at
        chunk = eight[starts[left] + at]
        short = rest < 8
        chunk[short] &= (np.uint64(1) << (rest[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[left] = mixed(out[left] ^ chunk) + np.uint64(0x9E3779B97F4A7C15)
        left = left[rest > 8]
        at += 8
    return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive hashes (order counts); shorter input has none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out = mixed(out + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + n]
    return mixed(out)


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
