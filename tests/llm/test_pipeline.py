"""The pipeline against brute force, stage by stage and as a whole."""

from collections import Counter

import brute
import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm.common import table
from tidemark.session import written

SF = "/root/testdata/sf0.001"


def expected():
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    rows = [r[:2] for r, kept in zip(rows, brute.kept_by_lines(rows), strict=True) if kept]
    yield rows
    sets, groups = brute.linked(rows, size=5, num=80, den=100)
    rows = [r for k, r in enumerate(rows) if not sets[k] or groups[k][0] == k]
    yield rows
    cut = []
    for doc_id, (data, mask) in zip((d for d, _ in rows), brute.repeats([t for _, t in rows]), strict=True):
        text, at, out = data.decode(), 0, []
        for c in text:
            size = len(c.encode())
            if not mask[at : at + size].all():
                out.append(c)
            at += size
        cut.append((doc_id, "".join(out)))
    yield cut
    clean = []
    for (doc_id, text), (_, _, hit, _) in zip(cut, brute.contaminated(cut, items), strict=True):
        spans = [m.span() for m in brute.ALPHANUMERIC.finditer(brute.lower(text))]
        gone = np.zeros(len(text), bool)
        for k in hit:
            # From one hit word to the next, what stands between them goes too.
            gone[spans[k][0] : spans[k + 1][0] if k + 1 in hit else spans[k][1]] = True
        clean.append((doc_id, "".join(c for c, g in zip(text, gone, strict=True) if not g)))
    yield clean
    yield list(brute.pieces(clean))


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        out.append(docs)
    return out


def test_each_stage_keeps_what_brute_force_keeps(stages):
    *texts, last = expected()
    for got, want in zip(stages, texts, strict=False):
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted(want)
        assert all(r["n_chars"] == len(r["text"]) for r in got.collect())
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in stages[-1].collect()) == Counter(last)
    assert len(texts[0]) < 200 and len(texts[1]) < len(texts[0]) and texts[2] != texts[1] and texts[3] != texts[2]


def test_run_gives_the_last_stage(spark, stages):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    run = corpus_pipeline.run(spark, SF)
    assert Counter(tuple(r[c] for c in columns) for r in run.collect()) == Counter(tuple(r[c] for c in columns) for r in stages[-1].collect())


def test_stages_carry_awkward_rows_and_columns(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars int, spans string, row_at int, node string, doc string"
    rows = [(k, t, "en", None, None, "s", 1, "n", "d") for k, t in enumerate([None, "", "a b", "é " * 300, " ".join(f"w{i}" for i in range(300))])]
    docs = written(spark.createDataFrame([*rows, rows[-1]], kind), "awkward")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = written(out, "awkward")
    assert [(r["doc_id"], r["spans"], r["node"]) for r in docs.collect()] == [(4, "s", "n")]


def test_an_empty_table_stays_empty(spark):
    docs = written(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"), "none")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "none")
        assert docs.count() == 0
