"""What a group of signatures gives, what memory it takes, and what a task gives back at its end."""

import tracemalloc
import weakref
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, partenum


def _group(blobs):
    """Blobs of ``(keys, signatures, owners)`` as the table that meets in a group."""
    columns = {"nodes": [], "signatures": [], "owners": []}
    for keys, signatures, owners in blobs:
        order = np.argsort(signatures)
        columns["nodes"].append(b"".join(keys))
        columns["signatures"].append(partenum._planes(np.diff(signatures[order], prepend=np.uint64(0))))
        columns["owners"].append(partenum._planes(owners[order].astype("<u4")))
    return pa.table({name: pa.chunked_array([pa.array(x, pa.binary()) for x in (values[:2], values[2:])], pa.binary()) for name, values in columns.items()})


@pytest.mark.parametrize("ordered", [1, 7, 1 << 18])
@pytest.mark.parametrize("values", [1 << 62, 30, 1])
def test_sets_meet_at_the_signatures_they_share(monkeypatch, ordered, values):
    monkeypatch.setattr(partenum, "ORDERED", ordered)
    rng = np.random.default_rng(values % 97)
    blobs, holders = [], defaultdict(set)
    for _ in range(4):
        keys = [bytes([k]) * 16 for k in rng.choice(9, 5, replace=False)]
        signatures = rng.integers(0, values, 40, dtype=np.uint64) << np.uint64(2)
        owners = rng.integers(0, 5, 40)
        blobs.append((keys, signatures, owners))
        for s, o in zip(signatures.tolist(), owners.tolist(), strict=True):
            holders[s].add(keys[o])
    several = {s: sorted(x) for s, x in holders.items() if len(x) > 1}
    rows = partenum._shared(_group(blobs)).to_pylist()
    pairs = Counter((x[0], y) for x in several.values() for y in x[1:])
    assert {(r["u"], r["v"]): r["shares"] for r in rows if r["signature"] is None} == pairs
    members = defaultdict(list)
    for r in rows:
        if r["signature"] is not None:
            members[r["signature"] % (1 << 64)].append(r["v"])
    assert all(several[s] == x for s, x in members.items())
    assert Counter(map(tuple, members.values())) == Counter(set(map(tuple, several.values())))


def test_a_group_of_signatures_takes_little_more_than_the_signatures():
    rng, n, blobs = np.random.default_rng(1), 50_000, []
    for k in range(20):
        keys = [bytes([k, i % 256, i // 256]).ljust(16, b"x") for i in range(500)]
        blobs.append((keys, rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 500, n)))
    group = _group(blobs)
    tracemalloc.start()
    try:
        partenum._shared(group)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 45 * n * len(blobs)


def test_a_task_gives_memory_back_when_it_holds_none(monkeypatch):
    alive = []

    def task(batches):
        held = np.zeros(10)
        watched = weakref.ref(held)
        monkeypatch.setattr(common, "release", lambda: alive.append(watched() is not None))
        yield from batches

    assert list(common.releasing(task)([1, 2])) == [1, 2]
    assert alive == [False]


def test_rows_of_signatures_are_read_few_at_a_time(spark, monkeypatch):
    seen, written = {}, partenum.written

    def noted(df, name, **options):
        seen[name] = int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")), options
        return written(df, name, **options)

    monkeypatch.setattr(partenum, "written", noted)
    before = spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(k % 2, 60))) for k in range(4)], "doc_id long, text string")
    rows = partenum.Join(docs, 4, 85, 100).linked().select("doc_id", "component_id").collect()
    assert sorted(map(tuple, rows)) == [(0, 0), (1, 0), (2, 0), (3, 0)]
    assert seen["shared"][0] <= 64 < int(before) == seen["sets"][0] and seen["sets"][1]
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == before
