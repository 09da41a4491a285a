"""Operator 7: benchmark decontamination with an FM-index per training shard.

A shard is some 16 MB of consecutive texts. Its words become numbers: those of the benchmark's vocabulary,
and one separator for everything else, for no phrase can cross another word. Stretches of vocabulary words
shorter than the shortest phrase cannot hold one either and are left out, so the index is built over the
few stretches that could. The index is a suffix array's Burrows-Wheeler transform with ranks from a wavelet
matrix and every eighth suffix position. All phrases are searched backwards at once; occurrences are located by
walking to the next sampled position, and their spans are merged.

Phrases are sent to every task in blocks of at most ``BLOCK_BYTES`` of benchmark text; each block is one pass.

NULL and empty texts have no words and are clean. An item without words has no phrase; one with a NULL id
is searched, but has no id to report; repeated items count once. Repeated documents are all reported. Empty tables: no
documents give no rows, no items make everything clean.
"""

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import ALPHANUMERIC, LOWER, hashed, keyed, placed, ready, runs, sliced, table, texts_of
from tidemark.session import written

WINDOW = 10
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 16 << 20
SAMPLED = 8


def words_of(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a text column's words, their bytes' starts and ends, the first word of each text, and the texts' offsets."""
    data, offsets = texts_of(column)
    data = LOWER[data]
    starts, ends, first = runs(ALPHANUMERIC[data[: offsets[-1]]], offsets)
    return hashed(data, starts, ends), starts, ends, first, offsets


class Phrases:
    """The distinct windows of some benchmark items, by length, over a vocabulary of word hashes."""

    def __init__(self, ids: list[str | None], texts: list[str | None], window: int):
        hashes, _, _, first, _ = words_of(pa.array(texts, pa.string()))
        self.vocabulary = np.unique(hashes)
        codes = np.searchsorted(self.vocabulary, hashes) + 2
        owners: dict[tuple, set[str]] = {}
        for k, item in enumerate(ids):
            own = codes[first[k] : first[k + 1]]
            size = min(window, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                owners.setdefault(tuple(own[at : at + size].tolist()), set()).update([] if item is None else [item])
        self.by_size: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for size in sorted({len(p) for p in owners}):
            own = [p for p in owners if len(p) == size]
            self.by_size[size] = (np.array(own, np.int64), [owners[p] for p in own])
        self.shortest = min(self.by_size, default=0)


class FmIndex:
    """Over numbers from 1 on; 0 is the end that it appends."""

    def __init__(self, text: np.ndarray):
        text = np.append(text, 0).astype(np.int64)
        self.n = len(text)
        order = suffix_array(text)
        self.last = text[order - 1]
        counts = np.bincount(text)
        self.before = np.cumsum(counts) - counts
        marked = order % SAMPLED == 0
        self.marked, self.mark_rank = marked, np.cumsum(marked) - marked
        self.samples = order[marked]
        # Wavelet matrix: per bit, from the highest, the zeros up to each place; then zeros go before ones.
        self.zeros, row = [], self.last
        for bit in reversed(range(max(1, int(text.max()).bit_length()))):
            ones = (row >> bit) & 1
            self.zeros.append((bit, np.concatenate([[0], np.cumsum(1 - ones)])))
            row = np.concatenate([row[ones == 0], row[ones == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place in the transform."""
        start, place = np.zeros_like(places), places.copy()
        for bit, zeros in self.zeros:
            one = ((symbols >> bit) & 1).astype(bool)
            start = np.where(one, zeros[-1] + start - zeros[start], zeros[start])
            place = np.where(one, zeros[-1] + place - zeros[place], zeros[place])
        return place - start

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row range of each pattern (one per row of a matrix), from its last symbol backwards."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        for k in reversed(range(patterns.shape[1])):
            symbol = np.minimum(patterns[:, k], len(self.before) - 1)
            known = patterns[:, k] < len(self.before)
            low, high = self.before[symbol] + self.rank(symbol, low), self.before[symbol] + self.rank(symbol, high)
            high = np.where(known, high, low)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows: steps back to the next sampled position are counted."""
        out, steps, left, at = np.zeros(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(left):
            here = self.marked[at]
            out[left[here]] = self.samples[self.mark_rank[at[here]]] + steps
            left, at = left[~here], at[~here]
            symbol = self.last[at]
            at = self.before[symbol] + self.rank(symbol, at)
            steps += 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; the last symbol must be the only smallest one."""
    rank, size = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        behind = np.zeros(len(rank), np.int64)
        behind[: len(rank) - size] = rank[size:] + 1
        key = rank * (len(rank) + 2) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == len(rank) - 1:
            return order
        size *= 2


def _occurrences(phrases: Phrases, sequence: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list]]:
    index = FmIndex(sequence)
    for size, (patterns, owners) in phrases.by_size.items():
        low, high = index.search(patterns)
        rows = np.repeat(low, high - low) + np.arange(int((high - low).sum())) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        yield size, np.repeat(np.arange(len(patterns)), high - low), index.locate(rows), owners


def _shard(phrases: Phrases, batches: list[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    parts, doc_base, n_words = [], 0, []
    for batch in batches:
        hashes, _, _, first, _ = words_of(batch.column("text"))
        n_words.append(np.diff(first))
        if phrases.shortest:
            at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
            starts, ends, _ = runs(phrases.vocabulary[at] == hashes, first)
            long_ = ends - starts >= phrases.shortest
            starts, sizes = starts[long_], (ends - starts)[long_]
            # Each stretch, then a separator (1).
            cut = np.cumsum(sizes + 1) - 1
            place = np.repeat(starts - (cut - sizes), sizes + 1) + np.arange(int((sizes + 1).sum()))
            place[cut] = 0
            symbols = (at + 2)[place] if len(place) else place
            symbols[cut] = 1
            doc = np.searchsorted(first, place, side="right") - 1
            parts.append((symbols, doc + doc_base, place - first[doc]))
        doc_base += batch.num_rows
    spans: dict[int, list[list[int]]] = {}
    items: dict[int, set[str]] = {}
    if parts and sum(len(p[0]) for p in parts):
        symbols, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        covered = np.zeros(len(symbols) + 1, np.int64)
        for size, which, at, owners in _occurrences(phrases, symbols):
            np.add.at(covered, at, 1)
            np.add.at(covered, at + size, -1)
            for d, w in np.unique(np.stack([doc[at], which], axis=1), axis=0).tolist():
                items.setdefault(d, set()).update(owners[w])
        hit = np.cumsum(covered[:-1]) > 0
        starts, ends, _ = runs(hit, np.array([0, len(hit)]))
        for a, b in zip(starts.tolist(), (ends - 1).tolist(), strict=True):
            spans.setdefault(int(doc[a]), []).append([int(place[a]), int(place[b]) + 1])
    doc_base = 0
    for batch, words in zip(batches, n_words, strict=True):
        rows = range(doc_base, doc_base + batch.num_rows)
        yield pa.RecordBatch.from_pydict(
            {
                **{c: batch.column(c) for c in columns},
                "n_words": pa.array(words),
                "spans": pa.array([spans.get(k, []) for k in rows], pa.list_(pa.list_(pa.int64()))),
                "items": pa.array([sorted(items.get(k, ())) for k in rows], pa.list_(pa.string())),
            }
        )
        doc_base += batch.num_rows


def _scan(ids: list, texts: list, window: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, held, size = Phrases(ids, texts, window), [], 0
        for batch in sliced(batches, "text"):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= SHARD_BYTES:
                yield from _shard(phrases, held, columns)
                held, size = [], 0
        if held:
            yield from _shard(phrases, held, columns)

    return run


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of at most ``BLOCK_BYTES``, one after the other; a longer item is a block of its own."""
    slim = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    ids, texts, size, some = [], [], 0, False
    for row in slim.toLocalIterator():
        more = 4 * len(row["text"] or "")
        if ids and size + more > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size, some = [], [], 0, True
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += more
    if ids or not some:
        yield ids, texts


def scanned(docs: DataFrame, benchmark: DataFrame, *columns: str, window: int = WINDOW) -> DataFrame:
    """Per document: ``columns``, ``n_words``, ``spans`` (of hit words, merged, as ``[from, to]``) and ``items`` (sorted ids)."""
    ready(docs.sparkSession)
    docs, out = placed(docs.select(*dict.fromkeys([*columns, "text"]))), []
    for k, (ids, texts) in enumerate(_blocks(benchmark)):
        first = k == 0
        rows = keyed(docs, *dict.fromkeys([*columns, "text"])) if first else keyed(docs, "text")
        kept = ["row_file", "row_at", *(columns if first else ())]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
        out.append(rows.mapInArrow(_scan(ids, texts, window, kept), f"{schema}, n_words long, spans array<array<long>>, items array<string>"))
    if len(out) == 1:
        return out[0].drop("row_file", "row_at")
    # Several blocks: what each found is gathered by row; only rows that it hit take part.
    first = written(out[0], "scanned")
    found = reduce(DataFrame.unionByName, [x.select("row_file", "row_at", "spans", "items").where("size(spans) > 0") for x in (first, *out[1:])])
    gathered = found.groupBy("row_file", "row_at").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merged = F.expr(
        "aggregate(spans, cast(array() as array<array<bigint>>), (a, s) -> if(size(a) > 0 and s[0] <= element_at(a, -1)[1],"
        " concat(slice(a, 1, size(a) - 1), array(array(element_at(a, -1)[0], greatest(element_at(a, -1)[1], s[1])))), concat(a, array(s))))"
    )
    gathered = gathered.withColumn("spans", merged)
    whole = first.drop("spans", "items").join(gathered, ["row_file", "row_at"], "left").drop("row_file", "row_at")
    none, no_items = F.expr("cast(array() as array<array<bigint>>)"), F.expr("cast(array() as array<string>)")
    return whole.withColumns({"spans": F.coalesce("spans", none), "items": F.coalesce("items", no_items)})


def without_spans(text: str, spans: list[list[int]]) -> str:
    """Take the hit words out, with what stands between them."""
    _, starts, ends, _, _ = words_of(pa.array([text]))
    data, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(data[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, data[at:]]).decode()


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id")
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + s[1] - s[0])")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
