"""The order of flat's files: every column of the curve skips pages by itself, at the default size of row groups."""

from datetime import date, timedelta
from decimal import Decimal
from itertools import pairwise
from math import exp

import pytest
from helpers import records, scanned_rows
from pyspark.sql import functions as F

from tidemark.operators import serve
from tidemark.plans import Snapshots, curve
from tidemark.sources import parse_records
from tidemark.streaming import apply_batch

ROWS = 240_000
TYPES = ("Fire", "Flood", "Hurricane", "Snow", "Storm", "Tornado")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """One bucket; a third of the rows in one state, amounts with a long tail, the columns independent of each other."""
    chance = [F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(1 << 30)) / (1 << 30) for k in range(4)]
    rows = spark.range(ROWS).select(
        F.to_json(
            F.struct(
                F.col("id").cast("string").alias("hash"),
                F.concat(F.lit("S"), F.when(chance[0] < 1 / 3, 0).otherwise(F.floor(chance[0] * 12))).alias("stateAbbreviation"),
                F.date_add(F.lit("2000-01-01"), F.floor(chance[1] * 7300).cast("int")).cast("string").alias("declarationDate"),
                F.element_at(F.array(*map(F.lit, TYPES)), (F.floor(chance[2] * 6) + 1).cast("int")).alias("incidentType"),
                F.round(F.exp(chance[3] * 16), 2).cast("decimal(20,2)").cast("string").alias("totalObligated"),
            )
        ).alias("value"),
        F.col("id").alias("seq"),
    )
    store = Snapshots(spark, str(tmp_path_factory.mktemp("curve")), buckets=1)
    apply_batch(store, parse_records(rows, "seq"), "s", 0)
    return store


@pytest.fixture(scope="module")
def whole(store):
    return store.flat().select("hash", "stateabbr", "declarationdate", "incidenttype", "totalobligated").collect()


MONEY = [Decimal(round(exp(1.6 * k), 2)).quantize(Decimal("0.01")) for k in range(11)]
DAYS = [date(2000 + 2 * k, 3, 1) for k in range(10)]


@pytest.mark.parametrize(
    "most, mean, slices",
    [
        (0.4, 1 / 3, [{"incidenttype": t} for t in TYPES]),
        (0.5, 0.4, [{"totalobligated": pair} for pair in pairwise(MONEY)]),
        (0.5, 1 / 3, [{"declarationdate": (day, day + timedelta(180))} for day in DAYS]),
        (1 / 6, 1 / 6, [{"stateabbr": f"S{k}"} for k in range(4, 12, 3)]),
        (0.2, 1 / 9, [{"incidenttype": t, "declarationdate": (DAYS[2], DAYS[2] + timedelta(180))} for t in TYPES]),
        (1 / 24, 1 / 24, [{"stateabbr": "S7", "declarationdate": (day, day + timedelta(180))} for day in DAYS[2:8:3]]),
    ],
)
def test_rows_read_for_each_column(store, whole, most, mean, slices):
    """At most and on average, of all rows. A range across the middle of its column costs most; with more pages all cost less."""
    read = []
    for at, conditions in enumerate(slices):
        found = serve.slice_by(store.flat(), **conditions).select("hash")

        def fits(row, conditions=conditions):
            ends = ((row[c], *(w if isinstance(w, tuple) else (w, w))) for c, w in conditions.items())
            return all(low <= value <= high for value, low, high in ends)

        read.append(scanned_rows(found) / ROWS)
        if at % 3 == 0:
            assert {r.hash for r in found.collect()} == {r.hash for r in whole if fits(r)}
    print(list(conditions), sum(read) / len(read), max(read))
    assert max(read) < most and sum(read) / len(read) < mean


def test_a_merged_bucket_lies_along_the_curve_too(spark, store, tmp_path, monkeypatch):
    from tidemark.plans import cycle
    from workload.inputs import copied

    monkeypatch.setattr(cycle, "LIGHT_LOADS", 0)
    own = copied(store, str(tmp_path / "copy"))
    for n in (1, 2):
        apply_batch(own, records(spark, {"hash": f"new{n}", "lastRefresh": f"2024-01-0{n}T00:00:00Z", "incidentType": "Quake"}), "t", n)
    assert [len(loads) for loads in own.head().flat.values()] == [1]
    assert scanned_rows(serve.slice_by(own.flat(), incidenttype="Storm").select("hash")) < 0.4 * ROWS
    assert own.flat().count() == ROWS + 2 and own.flat().where("incidenttype = 'Quake'").count() == 2


def test_places_on_the_curve_change_one_bit_at_a_time(spark):
    """All cells of a small curve: each is one place, and neighbours differ in one bit of one rank."""
    rows = spark.sql(
        "SELECT cast(s AS string) stateabbr, date_add(date'2000-01-01', d) declarationdate, cast(i AS string) incidenttype, cast(a AS decimal(38,10)) totalobligated"
        " FROM (SELECT explode(sequence(1, 2)) s), (SELECT explode(sequence(0, 3)) d), (SELECT explode(sequence(0, 3)) i), (SELECT explode(sequence(0, 3)) a)"
    )
    found = sorted(curve.along(rows, curve.edges(rows), "at").collect(), key=lambda r: r["at"])
    assert len({r["at"] for r in found}) == 128 and [r.stateabbr for r in found] == ["1"] * 64 + ["2"] * 64
    for a, b in zip(found, found[1:], strict=False):
        if a.stateabbr == b.stateabbr:
            changed = [abs(int(x) - int(y)) for x, y in ((a.incidenttype, b.incidenttype), (a.totalobligated, b.totalobligated))]
            changed.append(abs((a.declarationdate - b.declarationdate).days))
            assert sum(c != 0 for c in changed) == 1 and max(changed) in (1, 2)


def test_unknown_values_and_empty_samples(spark):
    rows = spark.createDataFrame([("a", None, None, None, None), ("b", "TX", date(2020, 1, 1), "Fire", Decimal(5))], "hash string, stateabbr string, declarationdate date, incidenttype string, totalobligated decimal(38,10)")
    assert [r["at"] for r in curve.along(rows, curve.edges(rows.limit(0)), "at").collect()] == [0, 0]
    known = curve.along(rows, curve.edges(rows), "at").orderBy("hash").collect()
    assert known[0]["at"] == 0 < known[1]["at"]
    assert curve.sampled(rows, 2).count() == 2


def test_a_sample_is_bounded_and_the_same_each_time(spark):
    rows = spark.range(400_000).select(F.col("id").cast("string").alias("hash"))
    taken = {r.hash for r in curve.sampled(rows, 400_000).collect()}
    assert 0.9 * curve.SAMPLE < len(taken) < 1.1 * curve.SAMPLE
    assert taken == {r.hash for r in curve.sampled(rows.repartition(7), 400_000).collect()}
