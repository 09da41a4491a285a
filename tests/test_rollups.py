"""Stored rollups equal those computed anew, whatever came between."""

import random

import pytest
from helpers import records
from pyspark.sql import functions as F

from tidemark.operators import serve
from tidemark.plans import Snapshots, cycle, rollups
from tidemark.streaming import apply_batch


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def anew(store):
    flat = store.flat()
    disasters = flat.groupBy("disasternumber").agg(*serve._measures())
    return {
        "state_incident": serve.rollup_state_incident(flat),
        "month_state": serve.rollup_month_state(flat),
        "status": serve.rollup_status(flat),
        "disaster": disasters,
    }


@pytest.mark.parametrize("light", [1, 8])
def test_rollups_follow_the_table(spark, tmp_path, monkeypatch, light):
    """New, moved and vanishing groups, NULL measures, loads on top of each other, merges, and several versions at once."""
    monkeypatch.setattr(cycle, "LIGHT_LOADS", light)
    chance = random.Random(11)
    store = Snapshots(spark, str(tmp_path / "s"), buckets=3)

    def some(n, day):
        return [
            {
                "hash": f"k{chance.randrange(60)}", "lastRefresh": f"2024-01-{day:02d}T00:00:00Z", "stateAbbreviation": chance.choice(["TX", "CA", None, f"S{day}"]),
                "incidentType": chance.choice(["Flood", "Fire", ""]), "declarationDate": f"2020-0{chance.randrange(1, 4)}-05", "projectStatus": chance.choice("ab"),
                "disasterNumber": chance.randrange(4), "totalObligated": chance.choice([None, "1.5", "-2.25", "0"]), "federalShareObligated": chance.choice([None, "7"]),
                "projectAmount": chance.choice([None, "3"]),
            }
            for _ in range(n)
        ]

    for step in range(6):
        apply_batch(store, records(spark, *some(50 if step == 0 else 8, step + 1)), "s", step)
        if step in (1, 3, 4):
            continue
        for name, want in anew(store).items():
            assert rows(rollups.rollup(store, name)) == rows(want.select(rollups.rollup(store, name).columns))
    assert rollups.stored_versions(store) == [1, 3, 6]


def test_an_unchanged_bucket_is_not_read(spark, tmp_path, monkeypatch):
    store = Snapshots(spark, str(tmp_path / "s"), buckets=16)
    apply_batch(store, records(spark, *({"hash": f"k{i}", "lastRefresh": "2024-01-01T00:00:00Z", "totalObligated": "1"} for i in range(200))), "s", 0)
    rollups.refresh(store)
    apply_batch(store, records(spark, {"hash": "k7", "lastRefresh": "2024-01-02T00:00:00Z", "totalObligated": "5"}), "s", 1)
    (changed,) = [b for b, loads in store.head().flat.items() if len(loads) > 1]
    frames = [df for df, _ in rollups._changes(store, store.commit(1), store.head())]
    assert {f"bucket={changed}/" in file for df in frames for file in df.inputFiles() if "/flat/" in file} == {True}
    assert [df.count() for df in frames] == [1, 1]
    assert rollups.rollup(store, "state_incident").select(F.col("total_obligated").cast("int")).collect()[0][0] == 204
