"""Operator 9: best-two-fit packing of tokenised documents into sequences.

Only lengths matter for packing, and there are at most ``capacity`` of them. Spark counts them; the bins are
then planned on that histogram, each plan step for as many equal bins as the counts allow, so the plan's
size follows the number of lengths and not of documents. A step fills one bin greedily, always with the
longest piece that still fits, then replaces the bin's shortest piece by the two unpacked pieces that fill
the widened gap best, as long as that leaves less room. Pieces of one length are exchangeable: each has a
rank among them, and the plan says which ranks go to which sequences.

NULL texts are empty and hold the end id alone; repeated rows and equal or NULL ``doc_id`` are packed like any
other; an empty table gives no pieces. Other columns are not read.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import ready, sliced, table
from tidemark.llm.tokens import SLICE, encoder, forget, with_end
from tidemark.session import written

CAPACITY = 2048

PIECES = "part int, doc_id long, piece int, start long, length int, local_rank long, ids binary, ids_crc32 long"


@dataclass
class Packing:
    """``pieces``: written, with their ids and places among equal lengths. ``plan``: see ``plan_bins``."""

    pieces: DataFrame
    plan: tuple[np.ndarray, ...]
    n_sequences: int

    def places(self, *columns: str) -> DataFrame:
        """``(doc_id, piece, start, length, sequence_id, offset)`` of every piece, and further columns of ``pieces``."""
        return _placed(self.pieces, self.plan, columns)

    def sequences(self) -> DataFrame:
        """``(sequence_id, ids)``: the ids of each sequence, at most ``capacity`` of them."""
        in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
        ids = F.expr("aggregate(transform(ordered, x -> x.ids), cast('' as binary), (a, b) -> concat(a, b))")
        grouped = self.places("ids").groupBy("sequence_id").agg(in_order.alias("ordered"))
        return grouped.select("sequence_id", ids.alias("ids"))


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[tuple[np.ndarray, ...], int]:
    """Plan all bins for ``length -> number of pieces``.

    Returns rows ``(length, first rank, first sequence, offset)``, sorted: the pieces of that length from
    that rank on go, one each, to consecutive sequences at that offset, until the next row of the length.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    index = np.arange(capacity + 1)
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        bin_, gap = [longest], capacity - longest
        left[longest] -= 1
        fits = np.maximum.accumulate(np.where(left > 0, index, 0))
        while gap and fits[gap]:
            take = int(fits[gap])
            bin_.append(take)
            gap -= take
            left[take] -= 1
            if not left[take]:
                fits = np.maximum.accumulate(np.where(left > 0, index, 0))
        while gap:
            shortest = min(bin_)
            room = gap + shortest
            fits = np.maximum.accumulate(np.where(left > 0, index, 0))
            first = np.flatnonzero(left[: room + 1] > 0)
            second = fits[room - first]
            # Two of one length need two of them; otherwise the next shorter one is second.
            twice = (second == first) & (left[first] < 2)
            second[twice] = fits[first[twice] - 1]
            second[second == 0] = -capacity
            both = first + second
            if not len(both) or both.max() <= shortest:
                break
            best = int(both.argmax())
            a, b = int(first[best]), int(second[best])
            bin_.remove(shortest)
            left[shortest] += 1
            bin_ += [a, b]
            left[a] -= 1
            left[b] -= 1
            gap = capacity - sum(bin_)
        wanted = Counter(bin_)
        times = 1 + min(int(left[x]) // n for x, n in wanted.items())
        offset = 0
        for length in sorted(bin_, reverse=True):
            rows.append((length, int(used[length]), sequence, offset))
            used[length] += times
            offset += length
        for x, n in wanted.items():
            left[x] -= n * (times - 1)
        sequence += times
    rows.sort()
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    return tuple(np.array(c, np.int64) for c in columns), sequence


def _pieces(path: str, spaced: bool, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in sliced(batches, "text", SLICE):
            coder = encoder(path, spaced)
            ids, counts = with_end(*coder.encode(batch.column("text")), end)
            kind = "<u2" if max(end, coder.tokenizer.get_vocab_size()) < 1 << 16 else "<u4"
            data, wide = memoryview(ids.astype(kind).tobytes()), memoryview(ids.astype("<u4").tobytes())
            width = np.dtype(kind).itemsize
            n_pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(capacity, counts[doc] - start)
            at = (np.cumsum(counts) - counts)[doc] + start
            order = np.argsort(length, kind="stable")
            inner = np.empty(len(length), np.int64)
            inner[order] = np.arange(len(length)) - np.searchsorted(length[order], length[order])
            rank = seen[length] + inner
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(doc), part, np.int32)),
                    "doc_id": batch.column("doc_id").take(pa.array(doc)),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start.astype(np.int64)),
                    "length": pa.array(length.astype(np.int32)),
                    "local_rank": pa.array(rank),
                    "ids": pa.array(
                        [bytes(data[width * a : width * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)],
                        pa.binary(),
                    ),
                    "ids_crc32": pa.array([zlib.crc32(wide[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)], pa.int64()),
                }
            )

    return run


def pack(docs: DataFrame, tokenizer: str, end: int, spaced: bool = False, capacity: int = CAPACITY) -> Packing:
    """Tokenise ``(doc_id, text)``, append the end id, cut what is longer than ``capacity``, and plan the bins.

    The driver holds one number per length, at most ``capacity`` of them.
    """
    ready(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = written(slim.mapInArrow(_pieces(tokenizer, spaced, end, capacity), PIECES), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan, n = plan_bins(counts, capacity)
    return Packing(pieces, plan, n)


def _placed(pieces: DataFrame, plan: tuple[np.ndarray, ...], columns: tuple[str, ...]) -> DataFrame:
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.select("part", "doc_id", "piece", "start", "length", "local_rank", *columns).join(before, ["part", "length"])
    rank = (F.col("local_rank") + F.col("before")).alias("rank")
    ranked = ranked.select("doc_id", "piece", "start", "length", *columns, rank)
    kept = [f.name for f in ranked.schema if f.name != "rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    lengths, ranks, sequences, offsets = plan
    keys = (lengths << 44) + ranks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            row = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            out = {c: batch.column(c) for c in kept}
            out["sequence_id"] = pa.array(sequences[row] + rank - ranks[row])
            out["offset"] = pa.array(offsets[row])
            yield pa.RecordBatch.from_pydict(out)

    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def packed_rows(docs: DataFrame) -> DataFrame:
    """Per piece its place and the checksum of its ids, with the word-level tokenizer and end id 0."""
    import public_tokenizers

    done = pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=0)
    return done.places("ids_crc32").select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(table(spark, sf_dir, "documents"))
