"""Operator 12: token counts of whole texts, by merging ragged arrays of byte-level BPE symbols round by round.

A text is cut into pre-tokens as the tokenizer file says; the distinct ones of a batch lie in one array of symbols,
one after the other. In each round every sequence finds the lowest rank among its pairs of neighbours and
merges all pairs of that rank, from the left, in all sequences at once; sequences without a pair that merges leave.
What is left of a sequence is its number of tokens. A merge's result has a higher rank than what it is made of
(checked when the file is read), so merging all pairs of a rank at once is the same as one after the other.

NULL and empty texts have no bytes and no tokens. Names of special tokens inside a text count as one token each, as the
library has it by default. Very long texts are cut into pre-tokens some 200,000 at a time; one pre-token is held
whole. Repeated rows, and equal or NULL ``doc_id``, each give a row; an empty table gives none. Columns of ``docs``
that the caller doesn't ask to carry aren't read, so their names don't matter.
"""

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import ready, sliced, table, texts_of

#: A document over the limit has more tokens than this.
LIMIT = 1024
#: Pre-tokens that are held at once, at most.
PIECES = 200_000
#: Fixed value: the pattern of byte-level BPE files that name no pattern of their own. White space as Unicode has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

_NONE = np.int64(1 << 40)
_tables: dict[str, "Merges"] = {}


def merges(path: str) -> "Merges":
    """One per worker process."""
    if path not in _tables:
        _tables[path] = Merges(path)
    return _tables[path]


def _characters() -> dict[str, int]:
    """The character by which such files write each byte: printable ones are themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Merges:
    """The merge table of one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if not plain or file["normalizer"] or model["type"] != "BPE" or any(model.get(k) for k in odd):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        added = file["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path} has special tokens that take in what stands beside them")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.pattern = regex.compile(PATTERN)
        number = model["vocab"]
        self.first = np.zeros(256, np.int64)
        for character, byte in _characters().items():
            self.first[byte] = number[character]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made: dict[str, int] = {}
        for rank, (a, b) in enumerate(pairs):
            if max(made.get(a, -1), made.get(b, -1)) >= rank or made.setdefault(a + b, rank) != rank:
                raise ValueError(f"{path} merges {a} and {b} out of order")
        if any(part not in made and len(part) > 1 for pair in pairs for part in pair):
            raise ValueError(f"{path} merges what no merge makes")
        # Keys of pairs in order, the rank of each, and what a rank makes.
        keys = np.array([number[a] << 32 | number[b] for a, b in pairs] + [1 << 62], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.where(order < len(pairs), order, _NONE)
        self.made = np.array([number[a + b] for a, b in pairs] + [0], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def symbols_left(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For byte sequences ``data[offsets[k]:offsets[k + 1]]``: how many symbols are left when nothing merges any more."""
        sizes = np.diff(offsets)
        out = sizes.copy()
        number = np.flatnonzero(sizes > 1)
        sizes = sizes[number]
        inside = np.zeros(int(offsets[-1]) + 1, bool)
        inside[: int(offsets[-1])] = np.repeat(np.diff(offsets) > 1, np.diff(offsets))
        symbols = self.first[data[: len(inside) - 1][inside[:-1]]]
        ranks = np.full(len(symbols), _NONE)
        ends = np.cumsum(sizes)
        pairs = np.ones(len(symbols), bool)
        pairs[ends - 1] = False
        pairs = np.flatnonzero(pairs)
        ranks[pairs] = self._rank(symbols[pairs], symbols[pairs + 1])
        while len(number):
            lowest = np.minimum.reduceat(ranks, ends - sizes)
            going = lowest < _NONE
            out[number[~going]] = sizes[~going]
            if not going.all():
                keep = np.repeat(going, sizes)
                symbols, ranks = symbols[keep], ranks[keep]
                number, sizes, lowest = number[going], sizes[going], lowest[going]
                if not len(number):
                    break
            # Pairs of the rank; of a run that overlaps, every other one from the left.
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            begins = np.ones(len(at), bool)
            begins[1:] = np.diff(at) > 1
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sizes = sizes - np.bincount(owner[at], minlength=len(sizes))
            at = at - np.cumsum(gone)[at]
            symbols, ranks, owner = symbols[~gone], ranks[~gone], owner[~gone]
            ends = np.cumsum(sizes)
            # Only pairs with a new symbol have another rank than before.
            fresh = np.zeros(len(symbols), bool)
            fresh[at] = fresh[np.maximum(at - 1, 0)] = True
            fresh = np.flatnonzero(fresh)
            ranks[fresh] = _NONE
            fresh = fresh[fresh + 1 < len(symbols)]
            fresh = fresh[owner[fresh] == owner[fresh + 1]]
            ranks[fresh] = self._rank(symbols[fresh], symbols[fresh + 1])
        return out

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """The pre-tokens of a text in lists; a number stands for so many special tokens."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield from self._cut(text[at : found.start()])
            yield 1
            at = found.end()
        yield from self._cut(text[at:] if at else text)

    def _cut(self, text: str) -> Iterator[list[str]]:
        if len(text) <= PIECES:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while some := [m[0] for m in islice(found, PIECES)]:
            yield some

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """The number of tokens of each text."""
        out, waiting, owners, sizes = np.zeros(len(texts), np.int64), [], [], []

        def flush() -> None:
            if waiting:
                coded = pa.array(waiting, pa.string()).dictionary_encode()
                left = self.symbols_left(*texts_of(coded.dictionary))
                total = np.concatenate([[0], np.cumsum(left[coded.indices.to_numpy()])])
                ends = np.cumsum(sizes)
                np.add.at(out, owners, total[ends] - total[ends - sizes])
            waiting.clear()
            owners.clear()
            sizes.clear()

        for k, text in enumerate(texts):
            for some in self.pieces(text or ""):
                if isinstance(some, int):
                    out[k] += some
                    continue
                waiting += some
                owners.append(k)
                sizes.append(len(some))
                if len(waiting) >= PIECES:
                    flush()
        flush()
        return out


def _counted(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merges(SparkFiles.get(name))
        for batch in sliced(batches, "text"):
            text = batch.column("text").cast(pa.string())
            counts = pa.array(own.counts(text.to_pylist()))
            n_bytes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("carried"), n_bytes, counts], ["carried", "n_bytes", "n_tokens"])

    return run


def counted(docs: DataFrame, path: str, *carried: str) -> DataFrame:
    """The ``carried`` columns of each document, with ``n_bytes`` and ``n_tokens`` of its ``text``. No row leaves its task.

    ``path`` is the tokenizer's file where the driver sees it; Spark hands it to the executors.
    """
    spark = ready(docs.sparkSession)
    spark.sparkContext.addFile(path)
    rows = docs.select(F.struct(*carried).alias("carried"), "text")
    kind = rows.schema["carried"].dataType.simpleString()
    found = rows.mapInArrow(_counted(path.rsplit("/", 1)[-1]), f"carried {kind}, n_bytes long, n_tokens long")
    return found.select("carried.*", "n_bytes", "n_tokens")


def op12_rank_merging(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    rows = counted(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), "doc_id")
    return rows.withColumn("over_limit", F.col("n_tokens") > LIMIT)
