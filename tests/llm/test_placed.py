"""Rows that come from no file give what the same rows in a file give, in each stage and operator that joins by row."""

from collections import Counter

import pytest
from pyspark.errors import AnalysisException

import corpus_pipeline
from tidemark.llm import decontaminate, katz, quality, suffixes
from tidemark.llm.common import keyed, table
from tidemark.llm.partenum import Join

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both(spark):
    stored = table(spark, SF, "documents")
    return stored, spark.createDataFrame(stored.collect(), stored.schema)


def rows(df, *columns):
    return Counter(str([r[c] for c in columns]) for r in df.collect())


def same(both, run, *columns):
    want, got = (rows(run(docs), *columns) for docs in both)
    assert want and got == want
    return want


def test_keys_need_a_file(both):
    assert keyed(both[0], "doc_id").count() == both[0].count()
    with pytest.raises(AnalysisException):
        keyed(both[1], "doc_id")


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_stages(spark, both, stage):
    assert stage[1](spark, both[1], SF).columns == both[0].columns
    same(both, lambda docs: stage[1](spark, docs, SF), *both[0].columns)


def test_packing_stage(spark, both):
    same(both, lambda docs: corpus_pipeline.packed(spark, docs, SF), "doc_id", "piece", "start", "length", "ids_crc32")


def test_op2_links_between_different_sets(both):
    found = same(both, lambda docs: Join(docs, 4, 85, 100).linked(), "doc_id", "n_shingles", "component_id")
    assert len(found) > 1


def test_op4_spans(both):
    same(both, lambda docs: suffixes.with_spans(docs, "doc_id").selectExpr("doc_id", "array_sort(spans) AS spans"), "doc_id", "spans")


def test_op5_verdicts(both):
    same(both, quality.judged, "doc_id", "n_common_words", "kept")


def test_op7_hits_of_later_blocks(spark, both, monkeypatch):
    benchmark = table(spark, SF, "benchmark")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 20_000)
    assert len(list(decontaminate._blocks(benchmark))) > 1
    same(both, lambda docs: decontaminate.scanned(docs, benchmark, "doc_id"), "doc_id", "n_words", "spans", "items")


def test_op8_counts(both):
    same(both, katz.scored, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
