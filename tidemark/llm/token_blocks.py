"""Operator 1: token ids in patched frame-of-reference blocks.

A block holds 256 ids: its minimum is subtracted, the rest is packed at the width that fits one of a few
percentiles of them, whichever makes the block smallest, and the others go to an exception list. A segment holds the blocks of consecutive whole documents
with an index of block starts, so any block can be read alone. Segments are rows of a Parquet table whose
files follow the order of ``doc_id``; Spark's committer makes a lost task leave nothing behind.

Segment layout, little-endian: ``PFR1``, ids (u32), blocks (u32), exceptions (u32); then per block its
start in the packed bytes (u32), minimum (u32), width (u8); per exception its place (u32) and its
difference from the minimum (u32); then the packed bytes.

NULL texts are empty, so they hold the end id alone. Rows with equal or NULL ``doc_id`` are all kept: NULL
first, equal ones in the order of their texts' hashes. An empty table gives no rows.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import ready, sliced, table
from tidemark.llm.tokens import SLICE, encoder, with_end
from tidemark.session import scratch_path

BLOCK = 256
FITTING = (0.75, 0.9, 0.97, 1.0)
SEGMENT_IDS = 1 << 16
MAGIC = b"PFR1"

SCHEMA = (
    "part int, segment int, first_id long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"
)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each number needs."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def pack(ids: np.ndarray) -> bytes:
    """One segment of ids (uint32) as bytes."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    values = np.zeros(blocks * BLOCK, np.uint32)
    values[:n] = ids
    if n:
        values[n:] = ids[-1]
    values = values.reshape(blocks, BLOCK)
    least = values.min(axis=1) if blocks else np.zeros(0, np.uint32)
    values = values - least[:, None]
    needed = _bits(values)
    places = [min(BLOCK - 1, int(BLOCK * f)) for f in FITTING]
    choices = np.partition(needed, places, axis=1)[:, places]
    # Bytes of each choice: the packed ids, and eight for each that does not fit.
    sizes = choices * (BLOCK // 8) + 8 * (needed[:, None, :] > choices[:, :, None]).sum(axis=2)
    widths = np.take_along_axis(choices, sizes.argmin(axis=1)[:, None], axis=1)[:, 0]
    outlying = needed > widths[:, None]
    places = np.flatnonzero(outlying)
    exceptions = values.reshape(-1)[places]
    sizes = widths * (BLOCK // 8)
    starts = np.cumsum(sizes) - sizes
    packed = np.zeros(int(sizes.sum()), np.uint8)
    for width in np.unique(widths[widths > 0]):
        own = np.flatnonzero(widths == width)
        bits = np.unpackbits(values[own].astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
        rows = np.packbits(bits.reshape(len(own), -1), axis=1)
        packed[starts[own][:, None] + np.arange(width * (BLOCK // 8))] = rows
    head = MAGIC + struct.pack("<III", n, blocks, len(places))
    index = [starts.astype("<u4"), least.astype("<u4"), widths.astype(np.uint8), places.astype("<u4"), exceptions.astype("<u4")]
    return b"".join([head, *(x.tobytes() for x in index), packed.tobytes()])


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks ``first`` to ``last`` (all by default); only their packed bytes are touched."""
    if payload[:4] != MAGIC:
        raise ValueError("not a segment of token blocks")
    n, blocks, n_exceptions = struct.unpack_from("<III", payload, 4)
    at = 16

    def column(kind: str, size: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(payload, kind, size, at)
        at += out.nbytes
        return out

    starts, least, widths = column("<u4", blocks), column("<u4", blocks), column("u1", blocks)
    places, exceptions = column("<u4", n_exceptions), column("<u4", n_exceptions)
    packed = np.frombuffer(payload, np.uint8, offset=at)
    last = blocks if last is None else last
    values = np.zeros((last - first, BLOCK), np.uint32)
    for width in np.unique(widths[first:last]):
        if width:
            own = np.flatnonzero(widths[first:last] == width)
            rows = packed[starts[first:last][own].astype(np.int64)[:, None] + np.arange(int(width) * (BLOCK // 8))]
            bits = np.zeros((len(own) * BLOCK, 32), np.uint8)
            bits[:, 32 - width :] = np.unpackbits(rows, axis=1).reshape(-1, width)
            values[own] = np.packbits(bits, axis=1).view(">u4").reshape(len(own), BLOCK)
    a, b = np.searchsorted(places, (first * BLOCK, last * BLOCK))
    values.reshape(-1)[places[a:b].astype(np.int64) - first * BLOCK] = exceptions[a:b]
    values += least[first:last][:, None]
    return values.reshape(-1)[: n - first * BLOCK]


def _segments(path: str, spaced: bool, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, lengths, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            row = {
                "part": pa.array([part], pa.int32()),
                "segment": pa.array([segment], pa.int32()),
                "first_id": pa.array([first], pa.int64()),
                "n_ids": pa.array([held], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "payload": pa.array([pack(np.concatenate(ids))], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(row)

        for batch in sliced(batches, "text", SLICE):
            flat, counts = with_end(*encoder(path, spaced).encode(batch.column("text")), end)
            ends = np.cumsum(counts)
            keys, at = batch.column("doc_id").to_pylist(), 0
            while at < len(keys):
                before = int(ends[at - 1]) if at else 0
                to = min(len(keys), int(np.searchsorted(ends, before + SEGMENT_IDS - held)) + 1)
                ids.append(flat[before : ends[to - 1]])
                doc_ids += keys[at:to]
                lengths += counts[at:to].tolist()
                held += int(ends[to - 1]) - before
                at = to
                if held >= SEGMENT_IDS:
                    yield flush()
                    segment, first = segment + 1, first + held
                    ids, doc_ids, lengths, held = [], [], [], 0
        if held:
            yield flush()

    return run


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end: int, spaced: bool = True) -> None:
    """Encode ``(doc_id, text)`` and write segments in ascending ``doc_id`` order.

    Texts are ranged by ``doc_id`` with their hash behind it, so that a repeated ``doc_id`` is split too.
    """
    ready(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).mapInArrow(_segments(tokenizer, spaced, end), SCHEMA).write.parquet(path)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, first, doc_ids, lengths, payload in zip(
            *(batch.column(c).to_pylist() for c in ("part", "first_id", "doc_ids", "lengths", "payload")), strict=True
        ):
            data = memoryview(unpack(payload).astype("<u4").tobytes())
            sizes = np.array(lengths, np.int64)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part] * len(sizes), pa.int32()),
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "at": pa.array(first + ends - sizes, pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths, strict=True)],
                        pa.int64(),
                    ),
                }
            )


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part: one row per written part, so the running total over them stays small."""
    parts = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the written segments: ``doc_id, start, n_tokens, ids_crc32``.

    The broadcast side has one short row per written part.
    """
    segments = spark.read.schema(SCHEMA).parquet(path)
    rows = segments.select("part", "first_id", "doc_ids", "lengths", "payload").mapInArrow(
        _checked, "part int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    joined = rows.join(F.broadcast(part_starts(spark, path)), "part")
    return joined.select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-blocks")
    write_blocks(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return read_blocks(spark, path)
