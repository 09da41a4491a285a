"""Operator 5: quality rules from cross-document line frequency.

Lines are normalised (words in lower case, single spaces) and hashed. Per host, here ``source``, the distinct
documents that hold a line are counted; exact copies of a text count once, or a copied document would make its own
lines common. Lines in more than ``MOST_SHARE`` of a host's documents, and in more than ``MOST_DOCS``, are
boilerplate, and are taken out of the texts, each with its line feed. A document that keeps less than ``LEAST_KEPT`` of its words, or fewer than ``LEAST_WORDS``, without
them is depleted and rejected.

NULL texts have no words and fail the base rule; a NULL source is a host of its own, the empty name. Repeated
rows each get their verdict. Very long texts are worked on alone. An empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import LOWER, PRINTED, as_signed, hashed, keyed, mixed, placed, ready, releasing, runs, sliced, table, texts_of, windows
from tidemark.session import written

MOST_SHARE, MOST_DOCS = 0.10, 50
LEAST_KEPT, LEAST_WORDS = 0.4, 10

REPEAT_WINDOW = 5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

FACTS = (
    "row_file long, row_at long, doc_id long, source string, text_hash long, n_words long, word_chars long,"
    " n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<line:long,words:long>>"
)


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out, some = np.zeros(len(offsets) - 1, np.int64), np.diff(offsets) > 0
    if some.any():
        out[some] = np.add.reduceat(marks, offsets[:-1][some], dtype=np.int64)
    return out


def repeated(hashes: np.ndarray, first: np.ndarray, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text, its words within windows of ``size`` words that the text has twice or more."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = windows(hashes, size)
    if not len(grams):
        return np.zeros(len(first) - 1, np.int64)
    whole = doc[: len(grams)] == doc[size - 1 :]
    keys = mixed(grams ^ mixed(doc[: len(grams)].astype(np.uint64)))
    ordered = np.sort(keys[whole])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        found = np.flatnonzero(whole & (twice[at] == keys))
        np.add.at(covered, found, 1)
        np.add.at(covered, found + size, -1)
    return _per_text(np.cumsum(covered[:-1]) > 0, first)


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all lines: each begins at its text's start or after a line feed."""
    starts = np.sort(np.concatenate([offsets[:-1], np.flatnonzero(data[: offsets[-1]] == 10) + 1]), kind="stable")
    return starts, np.append(starts[1:], offsets[-1])


def line_hashes(folded: np.ndarray, from_: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Hashes of lines that have words, of the hashes of their words in lower case."""
    if not len(from_):
        return np.zeros(0, np.uint64)
    place = np.arange(len(folded)) - np.repeat(from_, to - from_)
    return mixed(np.add.reduceat(mixed(folded + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), from_))


def without_lines(text: str, lines: list[int]) -> str:
    """Take out the lines with these hashes."""
    data, offsets = texts_of(pa.array([text]))
    starts, ends, _ = runs(PRINTED[data[: offsets[-1]]], offsets)
    line_starts, line_ends = lines_of(data, offsets)
    from_, to = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    worded = np.flatnonzero(to > from_)
    own = as_signed(line_hashes(hashed(LOWER[data], starts, ends), from_[worded], to[worded]))
    gone = set(worded[np.isin(own, np.array(lines, np.int64))].tolist())
    return "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        data, offsets = texts_of(batch.column("text"))
        n, body = len(offsets) - 1, data[: offsets[-1]]
        inside = PRINTED[body]
        starts, ends, first = runs(inside, offsets)
        n_words = np.diff(first)
        small = LOWER[data]
        words, folded = hashed(data, starts, ends), hashed(small, starts, ends)
        line_starts, line_ends = lines_of(data, offsets)
        from_, to = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
        worded = np.flatnonzero(to > from_)
        from_, to = from_[worded], to[worded]
        # Empty texts and trailing line feeds make lines without words. Others are compared up to the line feed or the text's end.
        line_text = np.searchsorted(first, from_, side="right") - 1
        stop = line_ends[worded] - (body[np.maximum(line_ends[worded] - 1, 0)] == 10)
        exact = mixed(hashed(data, line_starts[worded], stop) ^ mixed(line_text.astype(np.uint64)))
        _, firsts = np.unique(exact, return_index=True)
        dup_lines = np.bincount(line_text, minlength=n) - np.bincount(line_text[firsts], minlength=n)
        line = line_hashes(folded, from_, to)
        own, firsts, which = np.unique(mixed(line ^ mixed(line_text.astype(np.uint64))), return_index=True, return_inverse=True)
        weights = np.bincount(which, weights=to - from_, minlength=len(own)).astype(np.int64)
        order = np.argsort(line_text[firsts], kind="stable")
        per_text = np.bincount(line_text[firsts], minlength=n)
        lines = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(as_signed(line[firsts][order])), pa.array(weights[order])], ["line", "words"]),
        )
        characters = inside & ((body & 0xC0) != 0x80)
        yield pa.RecordBatch.from_pydict(
            {
                **{c: batch.column(c) for c in ("row_file", "row_at", "doc_id", "source")},
                "text_hash": pa.array(as_signed(hashed(data, offsets[:-1], offsets[1:]))),
                "n_words": pa.array(n_words),
                "word_chars": pa.array(_per_text(characters, offsets)),
                "n_symbols": pa.array(_per_text(SYMBOLS[body], offsets)),
                "n_dup_lines": pa.array(dup_lines),
                "n_repeat_words": pa.array(repeated(words, first)),
                "lines": lines,
            }
        )


def judged(docs: DataFrame, share: float = MOST_SHARE, least_docs: int = MOST_DOCS) -> DataFrame:
    """Per row its key, the base counts, ``base_failed``, ``n_common_words`` (in boilerplate lines), their hashes
    ``common_lines`` (NULL if none) and ``kept``."""
    ready(docs.sparkSession)
    docs = placed(docs.select("doc_id", "text", "source"))
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("source", F.lit("")).alias("source"))
    facts = written(rows.mapInArrow(releasing(_facts), FACTS), "quality-facts")
    lines = facts.select("row_file", "row_at", "source", "text_hash", F.inline("lines"))
    hosts = facts.groupBy("source").agg(F.count_distinct("text_hash").alias("docs"))
    counted = lines.groupBy("source", "line").agg(F.count_distinct("text_hash").alias("n"))
    common = counted.where(F.col("n") > least_docs).join(hosts, "source").where(F.col("n") > share * F.col("docs"))
    lost = lines.join(common.select("source", "line"), ["source", "line"]).groupBy("row_file", "row_at")
    lost = lost.agg(F.sum("words").alias("lost"), F.collect_set("line").alias("common_lines"))
    out = facts.drop("lines", "text_hash").join(lost, ["row_file", "row_at"], "left")
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_common_words")
    depleted = (left < LEAST_WORDS) | (left < LEAST_KEPT * F.col("n_words"))
    out = out.withColumn("n_common_words", F.coalesce("lost", F.lit(0))).drop("lost").withColumn("base_failed", base_failed)
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines = batch.column("text").to_pylist(), batch.column("common_lines").to_pylist()
        clean = pa.array([without_lines(t, x) if x else t for t, x in zip(texts, lines, strict=True)], pa.string())
        rest = [c for c in batch.schema.names if c not in ("text", "common_lines")]
        yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in rest}, "clean_text": clean})


def cleaned(docs: DataFrame, share: float = MOST_SHARE, least_docs: int = MOST_DOCS) -> DataFrame:
    """What ``judged`` gives per row, without the key, and ``clean_text``: the text without its boilerplate lines."""
    docs = placed(docs.select("doc_id", "text", "source"))
    found = judged(docs, share, least_docs).join(keyed(docs, "text"), ["row_file", "row_at"]).drop("row_file", "row_at", "source")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.drop("text", "common_lines").schema)
    return found.mapInArrow(_clean, f"{schema}, clean_text string")


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_common_words", "clean_text"
    )
