import json
import random
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import page, plan, records, scanned_rows, shown, utc
from pyspark.sql import functions as F

from tidemark.operators import flat as flat_ops, landing as landing_ops
from tidemark.operators.checks import quarantine
from tidemark.operators.landing import LATEST_REFRESH, fold, to_landing
from tidemark.operators.mark import TODAY_GUARD
from tidemark.plans import Commit, Snapshots, cycle, ranges, run_cycle, snapshots
from tidemark.plans.snapshots import ConcurrentPublish
from tidemark.sources import incremental, page_folder, parse_records
from tidemark.streaming import apply_batch, start_stream
from workload import inputs

AS_OF = datetime(2024, 1, 20, 10, 30)


def day(n):
    return f"2024-01-{n:02d}T00:00:00Z"


@pytest.fixture
def store(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "store"), buckets=4)


def source_of(spark, *rows):
    recs = records(spark, *rows)
    return lambda mark: incremental(recs, mark)


def tables(store):
    return shown(store.landing()), shown(store.flat())


def test_nothing_published_reads_as_empty_tables(store):
    assert store.head() == Commit()
    assert store.landing().count() == 0 and store.flat().count() == 0
    assert store.flat().columns[:2] == ["hash", "lastrefresh"]
    assert store.unreferenced().count() == 0


def test_first_cycle_loads_everything_then_only_from_the_mark(spark, store):
    rows = [{"hash": f"k{i}", "lastRefresh": day(1 + i), "county": f"C{i}"} for i in range(9)]
    report = run_cycle(store, source_of(spark, *rows, {"county": "no key"}), AS_OF)
    # The boundary row is read again by the sweep of the same cycle and does not duplicate.
    assert (report.version, report.sent, report.rejected, report.inserted, report.updated) == (1, 10, 1, 9, 0)
    assert report.mark == utc(2024, 1, 9)
    assert store.landing().count() == store.flat().count() == 9

    later = [{"hash": "k1", "lastRefresh": day(8), "county": "late"}, {"hash": "k2", "lastRefresh": day(12), "county": "N"}]
    report = run_cycle(store, source_of(spark, *rows, *later), AS_OF)
    assert (report.version, report.inserted, report.updated) == (2, 0, 1)
    counties = {r.hash: r.county for r in store.flat().collect()}
    assert counties["k1"] == "C1" and counties["k2"] == "N" and len(counties) == 9


def test_a_cycle_without_news_rewrites_nothing(spark, store):
    source = source_of(spark, {"hash": "a", "lastRefresh": day(3)}, {"hash": "b"})
    run_cycle(store, source, AS_OF)
    before = store.head()
    report = run_cycle(store, lambda mark: incremental(source(None), utc(2025, 1, 1)), AS_OF)
    assert report.version == before.version and store.head() == before
    report = run_cycle(store, source, AS_OF)
    after = store.head()
    assert report.updated == 0 and after.flat == before.flat


def test_today_guard_skips_records_between_mark_and_midnight(spark, store):
    run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(10)}), AS_OF)
    source = source_of(spark, {"hash": "missed", "lastRefresh": day(15)}, {"hash": "b", "lastRefresh": day(20)})
    report = run_cycle(store, source, AS_OF, mark_policy=TODAY_GUARD)
    assert report.mark == utc(2024, 1, 20)
    assert {r.hash for r in store.flat().collect()} == {"a", "b"}
    run_cycle(store, lambda mark: source(utc(2024, 1, 1)), AS_OF)
    assert {r.hash for r in store.flat().collect()} == {"a", "b", "missed"}


def test_replace_mode_starts_over_and_readers_keep_the_old_version(spark, store):
    run_cycle(store, source_of(spark, *({"hash": f"old{i}"} for i in range(20))), AS_OF)
    old = store.head()

    def source(mark):
        assert store.head() == old and store.flat().count() == 20
        return source_of(spark, {"hash": "new", "lastRefresh": day(2)})(mark)

    report = run_cycle(store, source, AS_OF, mode="replace")
    assert report.version == 2 and {r.hash for r in store.flat().collect()} == {"new"}
    assert store.flat(old).count() == 20
    run_cycle(store, source_of(spark), AS_OF, mode="replace")
    assert store.landing().count() == store.flat().count() == 0


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"), buckets=16)
    run_cycle(store, source_of(spark, *({"hash": f"k{i}", "lastRefresh": day(1)} for i in range(200))), AS_OF)
    before = store.head()
    run_cycle(store, source_of(spark, {"hash": "k7", "lastRefresh": day(9), "county": "X"}), AS_OF)
    after = store.head()
    assert sum(before.landing[b] != after.landing[b] for b in before.landing) == 1
    assert sum(before.flat[b] != after.flat[b] for b in before.flat) == 1
    assert store.landing().count() == store.flat().count() == 200
    assert all(len(loads) <= 3 for loads in after.landing.values())
    # The first loads still hold the other buckets; only what was staged is not needed any more.
    assert {r.table for r in store.unreferenced(keep=1).collect()} == {"staged"}


def written_bytes(store, table, load):
    return sum(f.stat().st_size for f in Path(store.root, table, f"load={load}").rglob("*.parquet"))


def test_a_small_batch_writes_and_compares_only_its_own_keys(spark, tmp_path, monkeypatch):
    store = Snapshots(spark, str(tmp_path / "s"), buckets=4)
    rows = [{"hash": f"k{i}", "lastRefresh": day(1), "text": f"{i:09d}" * 40} for i in range(2000)]
    run_cycle(store, source_of(spark, *rows), AS_OF)
    before, reads, read = store.head(), [], Snapshots.read

    def noted(self, table, *args, **options):
        reads.append((table, read(self, table, *args, **options)))
        return reads[-1][1]

    monkeypatch.setattr(Snapshots, "read", noted)
    run_cycle(store, source_of(spark, *({"hash": f"k{i}", "lastRefresh": day(9), "county": "X"} for i in range(0, 2000, 200))), AS_OF)
    monkeypatch.undo()
    after = store.head()
    (new,) = {loads[-1] for loads in after.landing.values()} - {loads[-1] for loads in before.landing.values()}
    assert written_bytes(store, "landing", new) < 0.2 * written_bytes(store, "landing", before.landing[0][0])
    assert [t for t, _ in reads].count("landing") == 1  # the rows that the batch replaces; no scan for the mark, none for the sync
    assert after.mark() == utc(2024, 1, 9) and store.landing().count() == store.flat().count() == 2000
    assert store.flat().where("county = 'X'").count() == store.landing().where("lastrefresh > '2024-01-02'").count() == 10


def test_a_sync_writes_what_changed(spark, tmp_path):
    """One key in a hundred of 15,000 records: flat's load holds those rows, and readers see the table as a rewrite would leave it."""
    published = inputs.published(spark, "/root/testdata/sf0.01")
    store = inputs.copied(published, str(tmp_path / "s"))
    base = {loads[0] for loads in store.head().flat.values()}
    whole = sum(written_bytes(store, "flat", load) for load in base)
    assert store.flat().count() == 15000 and whole < 5_000_000
    members = inputs.record_members(spark, "/root/testdata/sf0.01").where("gmProjectId % 100 = 1")
    batch = parse_records(inputs.as_records(members.withColumns({"lastRefresh": F.lit(day(19)), "county": F.lit("X")}), "gmProjectId"), "seq")
    # A flat row without a refresh is never replaced.
    known = published.flat().where("lastrefresh IS NOT NULL").select("hash")
    expected = flat_ops.flatten(landing_ops.fold(landing_ops.to_landing(batch))).join(known, "hash", "left_semi")
    before = store.head()
    run_cycle(store, lambda mark: batch, AS_OF)
    after = store.head()
    assert all(after.flat[b][0] == before.flat[b][0] for b in before.flat)
    (load,) = {x for loads in after.flat.values() for x in loads[1:]}
    changed = expected.count()
    assert after.late[load] == changed == spark.read.parquet(f"{store.root}/flat/load={load}").count()
    assert written_bytes(store, "flat", load) + written_bytes(store, "replaced", load) < 0.1 * whole
    kept = published.flat().join(expected.select("hash"), "hash", "left_anti").select(*expected.columns)
    assert shown(store.flat()) == shown(kept.unionByName(expected))
    assert store.flat(before).where("county = 'X'").count() == 0


def test_layered_reads_shuffle_nothing_and_stay_within_a_broadcast(spark, tmp_path, with_conf):
    """Places of replaced rows add up over loads; the load that would pass the limit is merged instead."""
    store = Snapshots(spark, str(tmp_path / "s"), buckets=2)
    everything = [{"hash": f"k{i}", "lastRefresh": day(1)} for i in range(300)]
    apply_batch(store, records(spark, *everything), "s", 0)
    with_conf(spark__sql__autoBroadcastJoinThreshold=str(100_000))
    merged = 0
    for n in range(1, 6):
        apply_batch(store, records(spark, *({**r, "lastRefresh": day(n + 1)} for r in everything[n * 10 : n * 10 + 100])), "s", n)
        head = store.head()
        assert sum(head.late.values()) * snapshots._PLACE_BYTES <= 100_000
        merged += n > 1 and any(len(loads) == 1 for held in (head.landing, head.flat) for loads in held.values())
        for df in (store.landing(), store.flat()):
            assert "Exchange" not in plan(df).replace("BroadcastExchange", "")
            assert df.count() == 300
    assert 0 < merged < 5
    newest = {r.hash: r.lastrefresh.day for r in store.flat().select("hash", "lastrefresh").collect()}
    assert newest == {f"k{i}": max([1] + [n + 1 for n in range(1, 6) if n * 10 <= i < n * 10 + 100]) for i in range(300)}


def test_the_mark_is_the_latest_refresh_in_landing(spark, store):
    run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(9)}, {"hash": "b", "lastRefresh": day(3)}), AS_OF)
    assert store.head().mark() == utc(2024, 1, 9)
    # A record that comes again with an older refresh takes its refresh back.
    apply_batch(store, records(spark, {"hash": "a", "lastRefresh": day(2)}), "s", 0)
    assert store.head().mark() == utc(2024, 1, 3)
    apply_batch(store, records(spark, {"hash": "a"}, {"hash": "c"}), "s", 1)
    assert store.head().mark() == utc(2024, 1, 3) == max(r.t for r in store.landing().selectExpr("lastrefresh as t").collect() if r.t).astimezone(timezone.utc)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_files_are_ordered_and_carry_statistics(spark, tmp_path, with_conf, threshold):
    with_conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    store = Snapshots(spark, str(tmp_path / "s"), buckets=2)
    states = ["TX", "CA", "NY", "FL"]
    for first in (1, 11):
        rows = [
            {"hash": f"k{i}", "lastRefresh": day(first + i % 9), "stateAbbreviation": states[i * 7 % 4]} for i in range(90)
        ]
        apply_batch(store, records(spark, *rows), "s", first)
    for table, column in (("landing", "lastrefresh"), ("flat", "stateabbr")):
        for path in (f for f in store.read(table).inputFiles() if f"/{table}/" in f):
            file = pq.ParquetFile(path.removeprefix("file://"))
            group = file.metadata.row_group(0)
            leaves = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
            assert leaves[column].statistics.has_min_max
            values = file.read([column]).column(0).to_pylist()
            assert values == sorted(values)


def test_loads_nothing_needs_are_listed(spark, tmp_path, monkeypatch):
    store = Snapshots(spark, str(tmp_path / "s"), buckets=1)
    for n in (1, 2, 3):
        run_cycle(store, source_of(spark, {"hash": "k", "lastRefresh": day(n)}), AS_OF)
    listed = sorted(r.table for r in store.unreferenced(keep=3).collect() if r.table != "staged")
    assert listed == []
    # The newest version of either table is made of all three loads, and of the places that the later ones replace.
    assert [r.table for r in store.unreferenced(keep=1).collect() if r.table != "staged"] == []
    assert {p.name.removeprefix("load=") for p in Path(store.root, "replaced").iterdir()} == set(store.head().late)
    staged = {p.name for p in Path(store.root, "staged").iterdir()}
    assert {r.load for r in store.unreferenced().collect() if r.table == "staged"} == staged

    def crash(*_):
        raise OSError("lost the connection")

    monkeypatch.setattr(Snapshots, "publish", crash)
    before = {(r.table, r.load) for r in store.unreferenced().collect()}
    with pytest.raises(OSError):
        run_cycle(store, source_of(spark, {"hash": "k", "lastRefresh": day(4)}), AS_OF)
    left = {(r.table, r.load) for r in store.unreferenced().collect()} - before
    assert {table for table, _ in left} == {"landing", "flat", "replaced", "counted", "staged"}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("policy", ["arrival", LATEST_REFRESH])
def test_cycles_equal_one_fold(spark, tmp_path, with_conf, threshold, policy):
    """Without broadcasts every merge shuffles; with them small batches do not. Same tables."""
    with_conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    chance = random.Random(5)
    store = Snapshots(spark, str(tmp_path / "s"), buckets=4)
    rows = []
    for step in range(3):
        part = [
            {
                "hash": "hot" if chance.random() < 0.34 else f"k{chance.randrange(40)}",
                "lastRefresh": chance.choice([None, day(1 + step * 5 + chance.randrange(9))]),
                "pwNumber": step * 1000 + i,
            }
            for i in range(60)
        ]
        rows += part
        apply_batch(store, records(spark, *part), "s", step, policy)
    landing, flat = tables(store)
    assert landing == shown(fold(to_landing(records(spark, *rows)), policy))
    assert {r[0] for r in flat} == {r[0] for r in landing}
    assert max(map(len, store.head().landing.values())) == (1 if threshold == "-1" else 3)


def test_loads_are_merged_after_some_light_ones(spark, store, monkeypatch):
    monkeypatch.setattr(cycle, "LIGHT_LOADS", 2)
    everything = [f"k{i}" for i in range(9)]
    for n, keys in enumerate([everything, everything, ["k1"], everything, everything]):
        apply_batch(store, records(spark, *({"hash": k, "lastRefresh": day(n + 1)} for k in keys)), "s", n)
        counts = {len(loads) for loads in store.head().landing.values()}
    # The third load gave one bucket a third load, so the fourth wrote all buckets anew.
    assert counts == {2}
    assert {r[2] for r in shown(store.landing())} == {"2024-01-05 00:00:00"}
    assert store.flat().count() == 9


def test_a_failed_publish_leaves_the_previous_version(spark, store, monkeypatch):
    run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(1), "county": "old"}), AS_OF)
    before = tables(store)

    def crash(*_):
        raise OSError("lost the connection")

    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "publish", crash)
        with pytest.raises(OSError):
            run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(2), "county": "new"}), AS_OF)
    assert tables(store) == before
    run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(2), "county": "new"}), AS_OF)
    assert [r.county for r in store.flat().collect()] == ["new"]


def test_a_refused_value_holds_back_the_cycle_or_flat_alone(spark, store):
    run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(1), "pwNumber": "1"}), AS_OF)
    bad = source_of(spark, {"hash": "a", "lastRefresh": day(2), "pwNumber": "one"}, {"hash": "b", "lastRefresh": day(2)})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_cycle(store, bad, AS_OF)
    assert store.head().version == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_cycle(store, bad, AS_OF, landing_first=True)
    assert store.landing().count() == 2 and store.flat().count() == 1
    # Flat catches up in a later cycle that has no news of its own.
    run_cycle(store, lambda mark: bad(utc(2025, 1, 1)), AS_OF, strict=False)
    assert {(r.hash, r.pwnumber) for r in store.flat().collect()} == {("a", None), ("b", None)}


def test_a_second_writer_of_the_same_version_fails(spark, store):
    run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(1)}), AS_OF)
    rival = Snapshots(spark, store.root)
    head = store.head()
    one = store.publish(replace(head, version=2, counts={"one": 1}))
    for n in range(4):
        with pytest.raises(ConcurrentPublish):
            rival.publish(replace(head, version=2, counts={"other": n}))
    assert store.head() == one and store.versions() == [1, 2]
    assert [r.version for r in store.history().collect()] == [1, 2]


def test_what_a_failed_commit_left_does_not_block_its_version(spark, store):
    Path(store.root, "commits", "version=1", "_temporary").mkdir(parents=True)
    assert store.versions() == [] and store.head() == Commit()
    assert run_cycle(store, source_of(spark, {"hash": "a", "lastRefresh": day(1)}), AS_OF).version == 1


def test_a_new_checkpoint_at_an_old_path_loses_nothing(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"), buckets=4)
    checkpoint = tmp_path / "checkpoint"
    page(tmp_path / "one", 0, {"hash": "a"})
    start_stream(store, str(tmp_path / "one"), str(checkpoint)).awaitTermination()
    start_stream(store, str(tmp_path / "one"), f"{checkpoint}/").awaitTermination()
    assert store.head().version == 1
    checkpoint.rename(tmp_path / "old checkpoint")
    page(tmp_path / "two", 0, {"hash": "b"})
    start_stream(store, str(tmp_path / "two"), str(checkpoint)).awaitTermination()
    assert {r.hash for r in store.landing().collect()} == {"a", "b"} and len(store.head().streams) == 2


def test_totals_count_each_record_once(spark, tmp_path):
    rows = [{"hash": k, "lastRefresh": day(1)} for k in "abc"]
    for landing_first in (False, True):
        store = Snapshots(spark, str(tmp_path / str(landing_first)), buckets=2)
        run_cycle(store, lambda mark: source_of(spark, *(rows if mark is None else []))(None), AS_OF, landing_first=landing_first)
        history = [(r.sent, r.inserted, r.total_sent) for r in store.history().orderBy("version").collect()]
        assert history == ([(3, 0, 3), (0, 3, 3)] if landing_first else [(3, 3, 3)])


def test_a_permissive_cycle_takes_what_it_can(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"), buckets=2)
    page(tmp_path / "pages", 0, {"hash": "a", "lastRefresh": "soon", "pwNumber": "one"}, {"hash": "b", "lastRefresh": day(2)})
    page(tmp_path / "pages", 1, body="{not json")
    with pytest.raises(Exception, match="MALFORMED_RECORD|CAST_INVALID_INPUT"):
        run_cycle(store, page_folder(spark, str(tmp_path / "pages")), AS_OF)
    report = run_cycle(store, page_folder(spark, str(tmp_path / "pages"), strict=False), AS_OF, strict=False)
    assert (report.inserted, report.mark) == (2, utc(2024, 1, 2))
    assert {(r.column, r.value) for r in quarantine(store.landing()).collect()} == {("lastrefresh", "soon"), ("pwnumber", "one")}


def test_a_replayed_micro_batch_changes_nothing(spark, store):
    batch = records(spark, {"hash": "a", "lastRefresh": day(1)})
    first = apply_batch(store, batch, "s", 0)
    assert apply_batch(store, records(spark, {"hash": "z"}), "s", 0) == first
    assert apply_batch(store, records(spark, {"hash": "b"}), "other stream", 0).version == 2
    assert {r.hash for r in store.landing().collect()} == {"a", "b"}


def test_an_empty_micro_batch_is_recorded(spark, store):
    commit = apply_batch(store, records(spark, {"hash": "a"}).where("false"), "s", 0)
    assert commit.streams == {"s": 0} and store.landing().count() == 0
    assert apply_batch(store, records(spark, {"hash": "a"}), "s", 1).version == 2


def drop(folder, step):
    """One drop of pages: keys repeat within a page, across pages and across drops."""
    for number in range(3):
        rows = [
            {"hash": f"k{(step + number + i) % 7}", "lastRefresh": None if i == 2 else day(1 + step * 3 + number), "pwNumber": step * 100 + number * 10 + i}
            for i in range(6)
        ]
        page(folder, step * 3 + number, *rows, {"pwNumber": 1})


@pytest.mark.parametrize("per_line", [False, True])
def test_stream_equals_batch(spark, tmp_path, per_line):
    pages, checkpoint = tmp_path / "pages", str(tmp_path / "checkpoint")
    streamed = Snapshots(spark, str(tmp_path / "streamed"), buckets=4)
    for step in range(3):
        drop(pages, step)
        start_stream(streamed, str(pages), checkpoint, per_line=per_line).awaitTermination()
    assert streamed.head().version == 3 and list(streamed.head().streams.values()) == [2]
    start_stream(streamed, str(pages), checkpoint, per_line=per_line).awaitTermination()
    assert streamed.head().version == 3

    batched = Snapshots(spark, str(tmp_path / "batched"), buckets=4)
    folder = page_folder(spark, str(pages), per_line)
    apply_batch(batched, folder(None), "s", 0)
    assert shown(streamed.landing()) == shown(batched.landing())
    assert streamed.head().counts["rejected"] == 3


def test_stream_resumes_after_a_failure(spark, tmp_path, monkeypatch):
    pages, checkpoint = tmp_path / "pages", str(tmp_path / "checkpoint")
    store = Snapshots(spark, str(tmp_path / "store"), buckets=4)
    drop(pages, 0)

    def crash(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "publish", crash)
        with pytest.raises(Exception, match="executor lost"):
            start_stream(store, str(pages), checkpoint).awaitTermination()
    assert store.head() == Commit()
    start_stream(store, str(pages), checkpoint).awaitTermination()
    assert store.head().version == 1 and store.landing().count() == 7


def test_stream_on_an_interval_keeps_picking_up_pages(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"), buckets=4)
    drop(tmp_path / "pages", 0)
    query = start_stream(store, str(tmp_path / "pages"), str(tmp_path / "checkpoint"), every="1 second")
    try:
        query.processAllAvailable()
        assert store.head().version == 1
        drop(tmp_path / "pages", 1)
        query.processAllAvailable()
    finally:
        query.stop()
    assert store.head().version == 2 and store.landing().count() == 7


def test_landing_published_first_is_not_loaded_twice(spark, store):
    bad = records(spark, {"hash": "a", "lastRefresh": day(1), "pwNumber": "one"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply_batch(store, bad, "s", 0, landing_first=True)
    assert store.head().streams == {"s": 0} and store.flat().count() == 0
    done = apply_batch(store, bad, "s", 0, strict=False, landing_first=True)
    assert done.version == 2 and store.landing().count() == store.flat().count() == 1
    assert [(r.version, r.sent, r.inserted, r.total_sent) for r in store.history().orderBy("version").collect()] == [(1, 1, 0, 1), (2, 0, 1, 1)]


def test_stream_takes_a_bounded_number_of_files_per_batch(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"), buckets=4)
    drop(tmp_path / "pages", 0)
    query = start_stream(store, str(tmp_path / "pages"), str(tmp_path / "checkpoint"), files_per_batch=1)
    query.awaitTermination()
    assert store.head().version == 3


def test_views_serve_plain_sql(spark, store):
    run_cycle(store, source_of(spark, {"hash": "a", "stateAbbreviation": "TX", "totalObligated": "2.5"}), AS_OF)
    store.register_views("l_view", "f_view")
    got = spark.sql("SELECT f.stateabbr, f.totalobligated FROM f_view f JOIN l_view l USING (hash)").collect()
    assert [(r.stateabbr, float(r.totalobligated)) for r in got] == [("TX", 2.5)]


def test_stored_records_survive_rewrites_unchanged(spark, store):
    odd = {
        "hash": "odd", "lastRefresh": day(1), "big": 12345678901234567890123, "exact": "12345678901234567890.123456789",
        "nested": {"list": [1, "1", None, {"x": []}], "é": "ü"}, "flag": False, "none": None, "text": "a" * 3000,
    }
    plain = [{"hash": f"k{i}", "lastRefresh": day(1), "big": i, "nested": i, "flag": str(i)} for i in range(30)]
    run_cycle(store, source_of(spark, odd, *plain), AS_OF)
    for n in range(2, 5):
        again = [{**r, "lastRefresh": day(n)} for r in plain[:3]]
        run_cycle(store, source_of(spark, *again), AS_OF)
    text = store.flat().where("hash = 'odd'").select(F.to_json("raw").alias("t")).first().t
    assert json.loads(text) == odd


def test_a_deep_page_reads_the_hours_that_hold_it(spark, tmp_path):
    """At the default size of row groups, with replaced rows, unknown refreshes and a hot hour."""
    store = Snapshots(spark, str(tmp_path / "s"), buckets=2)
    rows = spark.range(120_000).select(
        F.to_json(
            F.struct(
                F.md5(F.col("id").cast("string").cast("binary")).alias("hash"),
                F.when(F.col("id") % 50 == 0, None)
                .when(F.col("id") % 29 == 0, F.lit("2020-05-05T05:05:05Z"))
                .otherwise(F.concat(F.date_format(F.timestamp_seconds(F.lit(1_500_000_000) + F.col("id") * 997), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
                .alias("lastRefresh"),
            )
        ).alias("value"),
        F.col("id").alias("seq"),
    )
    apply_batch(store, parse_records(rows, "seq"), "s", 0)
    again = rows.where("seq % 997 = 5").withColumn("value", F.regexp_replace("value", '"lastRefresh":"[^"]*"', '"lastRefresh":"2030-01-01T00:00:00Z"'))
    apply_batch(store, parse_records(again, "seq"), "s", 1)
    assert store.head().late
    order = [r.hash for r in store.landing().orderBy(F.asc_nulls_first("lastrefresh"), "hash").select("hash").collect()]
    for skip in (0, 2390, 60_000, 90_000, 119_800):
        got = [(r.position, r.hash) for r in store.page(skip, 300).collect()]
        assert got == list(zip(range(skip, skip + 300), order[skip : skip + 300], strict=False))
    assert store.page(120_000, 10).collect() == []
    counted = {r.bucket: r.n for r in store.counted(store.head()).groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    assert counted == {r.bucket: r["count"] for r in store.read("landing").groupBy("bucket").count().collect()}
    span = ranges.span(store.counted(store.head()), 90_000, 300)
    left = store.landing().select("hash", "lastrefresh").where(span.holds("lastrefresh"))
    assert scanned_rows(left) < 0.05 * 120_000


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_behind(spark, tmp_path):
    import time

    store = Snapshots(spark, str(tmp_path / "s"), buckets=2)
    before = shuffle_files(spark)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("hash"), F.parse_json(F.lit("{}")).alias("raw"), F.lit(None).cast("timestamp").alias("lastrefresh"))
    store.stage(rows.repartition(3, "hash"), "x")
    store.write("landing", rows.repartition(3, "hash").withColumn("bucket", F.lit(0)))
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_a_merge_goes_by_groups_of_buckets_and_shuffles_flat_once(spark, tmp_path, with_conf, monkeypatch):
    """With more shuffle partitions than buckets the join takes the buckets' partitions; each bucket is a group of its own here."""
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="50")
    monkeypatch.setattr(cycle, "MERGED_AT_ONCE", 1)
    store = Snapshots(spark, str(tmp_path / "s"), buckets=3)
    plans, write = [], store.write

    def keep(table, df, *rows):
        plans.append((table, plan(df)))
        return write(table, df, *rows)

    apply_batch(store, records(spark, *({"hash": f"k{i}", "lastRefresh": day(1), "pwNumber": 1} for i in range(300))), "s", 0)
    store.write = keep
    apply_batch(store, records(spark, *({"hash": f"k{i}", "lastRefresh": day(2), "pwNumber": 2} for i in range(200, 400))), "s", 1)
    head = store.head()
    assert [t for t, _ in plans] == ["landing"] * 3 + ["flat"] * 3
    for held in (head.landing, head.flat):
        assert [len(loads) for loads in held.values()] == [1, 1, 1] and len({loads[0] for loads in held.values()}) == 3
    for table, text in plans:
        assert text.count("Exchange hashpartitioning(hash") <= (2 if table == "landing" else 4) and ", 50)" not in text
    found = {r.hash: r.pwnumber for r in store.flat().select("hash", "pwnumber").collect()}
    assert found == {f"k{i}": 1 if i < 200 else 2 for i in range(400)} and store.landing().count() == store.flat().count() == 400
    assert sum(r.n for r in store.counted(head).collect()) == 400


def test_new_rows_are_put_on_top_however_many_they_are(spark, tmp_path, with_conf):
    """Keys beyond the broadcast limit: only places of replaced rows have to fit it, and those of few rows do."""
    store = Snapshots(spark, str(tmp_path / "s"), buckets=2)
    apply_batch(store, records(spark, *({"hash": f"k{i}", "lastRefresh": day(1), "pwNumber": 1} for i in range(100))), "s", 0)
    with_conf(spark__sql__autoBroadcastJoinThreshold="20000")
    base = store.head()
    apply_batch(store, records(spark, *({"hash": f"k{i}", "lastRefresh": day(2), "pwNumber": 2} for i in range(95, 600))), "s", 1)
    head = store.head()
    for table in ("landing", "flat"):
        now, was = getattr(head, table), getattr(base, table)
        assert all(len(now[b]) == 2 and now[b][0] == was[b][0] for b in was)
    assert sorted(head.late.values()) == [5, 5] and head.counts["inserted"] == 500 and head.counts["updated"] == 5
    found = {r.hash: r.pwnumber for r in store.flat().select("hash", "pwnumber").collect()}
    assert found == {f"k{i}": 1 if i < 95 else 2 for i in range(600)} and store.flat().count() == store.landing().count() == 600
    # Many replaced rows are merged.
    apply_batch(store, records(spark, *({"hash": f"k{i}", "lastRefresh": day(3), "pwNumber": 3} for i in range(400))), "s", 2)
    assert {len(loads) for held in (store.head().landing, store.head().flat) for loads in held.values()} == {1}
    assert store.flat().where("pwnumber = 3").count() == 400 and store.flat().count() == 600
