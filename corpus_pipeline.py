"""The corpus pipeline: five operators, each working on all that the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, with the columns of ``docs``; the
last returns places in sequences. ``run`` writes each result to the shared folder and reads it again.

Rows without a text pass the stages that cut, and fail the quality rules. Repeated rows are copies, of
which the second stage keeps one. An empty table stays empty. Further columns are carried, whatever their names.
"""

from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, packing, quality, suffixes
from tidemark.llm.common import keyed, placed, ready, releasing, table
from tidemark.llm.partenum import Join
from tidemark.session import discard, noting_scratch, written

#: Near copies: sets of five-word n-grams with a similarity of 0.8 or more.
WORDS, NUM, DEN = 5, 80, 100


def _whole(docs: DataFrame) -> DataFrame:
    """Each document as one value, so that no name of its columns meets a name used here; and its text."""
    return docs.select(F.struct("*").alias("doc"), "text")


def _kept(docs: DataFrame, rows: DataFrame) -> DataFrame:
    return keyed(_whole(docs), "doc").join(rows.select("row_file", "row_at"), ["row_file", "row_at"], "left_semi").select("doc.*")


def _cut(without_spans):
    """Replace the texts that have spans; ``n_chars`` follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc")
            columns = dict(zip((f.name for f in doc.type), doc.flatten(), strict=True))
            texts, spans = columns["text"].to_pylist(), batch.column("spans").to_pylist()
            new = [without_spans(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            columns["text"] = pa.array(new, pa.string())
            if "n_chars" in columns:
                sizes = [len(t) if s else n for t, s, n in zip(new, spans, columns["n_chars"].to_pylist(), strict=True)]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(list(columns.values()), fields=list(doc.type))], ["doc"])

    return run


def _without(found: DataFrame, without_spans) -> DataFrame:
    kind = found.schema["doc"].dataType.simpleString()
    return found.select("doc", "spans").mapInArrow(releasing(_cut(without_spans)), f"doc {kind}").select("doc.*")


#: Tables that stages wrote on their way, by application. A stage's result is written before the next stage begins, which needs none of them.
_left: dict[str, list[str]] = {}


def _stage(step):
    """Before a stage begins, delete what earlier ones left; its documents must not be read from there."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = _left.setdefault(spark.sparkContext.applicationId, [])
        read = {file.rsplit("/", 2)[-2] for file in docs.inputFiles()}
        if not any(path.rsplit("/", 1)[-1] in read for path in left):
            discard(spark, left)
            left.clear()
        with noting_scratch() as paths:
            kept = step(spark, docs, sf_dir)
        left += paths
        return kept

    return run


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and boilerplate lines are taken out of the texts of the others."""
    docs = placed(docs)
    kept = quality.judged(docs).where("kept").select("row_file", "row_at", F.col("common_lines").alias("spans"))
    return _without(keyed(_whole(docs), "doc").join(kept, ["row_file", "row_at"]), quality.without_lines)


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest ``doc_id`` stays; documents without words all do."""
    docs = placed(docs)
    rows = written(Join(docs, WORDS, NUM, DEN).linked(), "linked")
    first = rows.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "row_file", "row_at")).alias("row"))
    alone = rows.where("root IS NULL").select("row_file", "row_at")
    return _kept(docs, first.select("row.row_file", "row.row_at").union(alone))


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes and more that stand anywhere else too are taken out of the texts."""
    return _without(suffixes.with_spans(_whole(docs), "doc"), suffixes.without_spans)


@_stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words within benchmark phrases are taken out of the texts."""
    # Written in between: two Python functions in one task would need twice the workers, which stay.
    found = written(decontaminate.scanned(_whole(docs), table(spark, sf_dir, "benchmark"), "doc"), "scanned")
    return _without(found, decontaminate.without_spans)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 2048 tokens."""
    return packing.packed_rows(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed),
]

#: SQL expresses neither the similarity join's components nor the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        with noting_scratch() as paths:
            docs = written(kept, name.replace(" ", "-"))
        discard(spark, before)
        before = paths
    return docs


PIPELINE = {"pipeline": run}
