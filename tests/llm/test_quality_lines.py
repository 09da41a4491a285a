"""Boilerplate lines are taken out of the texts, by the operator and by the pipeline's stage."""

from collections import defaultdict

import brute
import pytest

import corpus_pipeline
from tidemark.llm import quality
from tidemark.session import written

KIND = "doc_id long, text string, source string, n_chars long"


def body(k):
    return " ".join(f"word{k}x{i}" for i in range(30))


def texts():
    for k in range(60):
        yield f"Shared  HEADER line\n{body(k)}\n\nshared header\tline\r\nlast {k}"
    yield body(60) + "\nshared header line"
    yield "shared header line"
    yield "Shared header line, not quite\n" + body(62) + "\n"
    yield None
    yield ""


def without_common(rows, share=0.10, least_docs=50):
    holders, hosts = defaultdict(set), defaultdict(set)

    def line(x):
        return tuple(brute.PRINTED.findall(brute.lower(x)))

    for _, text, host, _ in rows:
        hosts[host].add(text or "")
        for x in (text or "").split("\n"):
            holders[host, line(x)].add(text or "")
    for doc_id, text, host, _ in rows:
        common = [x for x in (text or "").split("\n") if line(x) and len(holders[host, line(x)]) > max(least_docs, share * len(hosts[host]))]
        yield doc_id, text if text is None else "\n".join(x for x in text.split("\n") if x not in common)


@pytest.fixture(scope="module")
def rows():
    hot = [(k, t, "hot", len(t or "")) for k, t in enumerate(texts())]
    return [*hot, hot[0], *[(100 + k, t, "cold", len(t or "")) for k, t in enumerate(list(texts())[:5])]]


def test_lines_are_taken_out(spark, rows):
    want = sorted(without_common(rows), key=repr)
    got = quality.cleaned(spark.createDataFrame(rows, KIND)).collect()
    assert sorted(((r["doc_id"], r["clean_text"]) for r in got), key=repr) == want
    assert sum(a != b for (_, a), (_, b) in zip(want, sorted([r[:2] for r in rows], key=repr), strict=True)) == 63


def test_the_stage_passes_on_texts_without_them(spark, rows):
    docs = written(spark.createDataFrame(rows, KIND), "lines")
    kept = {r["doc_id"] for r in quality.judged(docs).where("kept").collect()}
    want = sorted(x for x in without_common(rows) if x[0] in kept)
    got = corpus_pipeline.quality_rules(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == want and all(r["n_chars"] == len(r["text"]) for r in got)
    assert not any("header line\r" in r["text"] or r["text"].startswith("Shared  ") for r in got if r["source"] == "hot")
