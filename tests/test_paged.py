"""The paged source: ranges, ends, repeated requests, offsets of the stream."""

import json
import sys
from collections import Counter
from dataclasses import dataclass
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import shown
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators.landing import fold, to_landing
from tidemark.plans import Snapshots
from tidemark.schema import ENVELOPE_KEY
from tidemark.sources import register_source, unwrap
from tidemark.sources.paged import PagedReader, PagedStreamReader, Requests, Settings
from tidemark.streaming import start_source_stream

# Executors don't know this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Listed:
    """A client over a file of records, one per line; requests are noted beside it, and some fail."""

    file: str
    failing: int = 0

    def fetch(self, skip, top, since):
        log = Path(f"{self.file}.log")
        with log.open("a") as out:
            out.write(f"{skip} {top}\n")
        times = Counter(log.read_text().splitlines())[f"{skip} {top}"]
        if top > 1 and skip % 20 == 0 and times <= self.failing:
            raise TimeoutError("no answer")
        rows = [json.loads(x) for x in Path(self.file).read_text().splitlines()]
        rows.sort(key=lambda r: (r.get("lastRefresh") or "", r["hash"]))
        found = [r for r in rows if since is None or (r.get("lastRefresh") or "") >= since]
        return json.dumps({ENVELOPE_KEY: found[skip : skip + top]})


def listed(path, *rows, **options):
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return Listed(str(path), **options)


def numbers(n, refresh=None):
    return [{"hash": f"{k:05d}", "lastRefresh": refresh} for k in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 10, 11, 39, 40, 41, 64, 100])
def test_count_and_ranges_cover_every_record(tmp_path, n):
    requests = Requests(listed(tmp_path / "rows", *numbers(n)), Settings(top=10, pages_per_task=2, pause=0))
    assert requests.count(None) == n
    assert len(Path(f"{requests.client.file}.log").read_text().splitlines()) <= 2 + 2 * max(1, n).bit_length()
    reader = PagedReader(requests)
    parts = reader.partitions()
    assert len(parts) == max(1, -(-n // 20)) and parts[-1].end is None
    found = [json.loads(v)[ENVELOPE_KEY] for part in parts for batch in reader.read(part) for v in batch.column("value").to_pylist()]
    assert [r["hash"] for page in found for r in page] == [f"{k:05d}" for k in range(n)]
    assert all(len(page) == 10 for page in found[:-1])


def test_records_that_come_while_pages_are_read(tmp_path):
    path = tmp_path / "rows"
    reader = PagedReader(Requests(listed(path, *numbers(25)), Settings(top=10, pages_per_task=1, pause=0)))
    parts = reader.partitions()
    listed(path, *numbers(47))
    assert sum(len(json.loads(v)[ENVELOPE_KEY]) for p in parts for b in reader.read(p) for v in b.column("value").to_pylist()) == 47


def test_a_source_is_read_in_tasks_that_ask_again(spark, tmp_path):
    register_source(spark, "listed_again", listed(tmp_path / "rows", *numbers(95), failing=2))
    pages = spark.read.format("listed_again").options(top=10, pagesPerTask=3, pause=0.01).load()
    assert pages.rdd.getNumPartitions() == 4
    rows = unwrap(pages).select(F.col("ord.page_seq").alias("s"), F.col("ord.pos").alias("p"), F.variant_get("rec", "$.hash", "string").alias("h"))
    assert sorted((r.s * 10 + r.p, int(r.h)) for r in rows.collect()) == [(k, k) for k in range(95)]


def test_a_source_that_stays_away_fails(spark, tmp_path):
    register_source(spark, "listed_away", listed(tmp_path / "rows", *numbers(30), failing=99))
    with pytest.raises(Exception, match="no answer"):
        spark.read.format("listed_away").options(top=10, pause=0, attempts=2).load().collect()
    with pytest.raises(Exception, match="a page holds"):
        spark.read.format("listed_away").option("top", 5000).load().collect()


def day(n):
    return f"2024-01-{n:02d}T00:00:00Z"


def test_offsets_say_how_far_a_batch_goes(tmp_path):
    path = tmp_path / "rows"
    rows = [{"hash": "x"}, {"hash": "a", "lastRefresh": day(1)}, {"hash": "b", "lastRefresh": day(2)}, {"hash": "c", "lastRefresh": day(2)}]
    stream = PagedStreamReader(Requests(listed(path, rows[0]), Settings(top=1, pause=0)))

    def read(start, end):
        parts = stream.partitions(start, end)
        return [json.loads(v)[ENVELOPE_KEY][0]["hash"] for p in parts for b in stream.read(p) for v in b.column("value").to_pylist()]

    first = stream.latestOffset()
    assert first == {"since": "", "skip": 1} and read(stream.initialOffset(), first) == ["x"]
    listed(path, *rows[:3])
    second = stream.latestOffset()
    assert second == {"since": day(2), "skip": 1} and read(first, second) == ["x", "a", "b"]
    stream.commit(second)
    assert stream.latestOffset() == second and read(second, second) == []
    listed(path, *rows)
    third = stream.latestOffset()
    assert third == {"since": day(2), "skip": 2} and read(second, third) == ["b", "c"]
    # A reader that knows nothing of the past, after a restart, finds the same end, and the batch has the same rows however much came since.
    listed(path, *rows, {"hash": "d", "lastRefresh": day(3)})
    again = PagedStreamReader(stream.requests)
    assert read(second, third) == ["b", "c"] and again.latestOffset() == {"since": day(3), "skip": 1}


def test_a_stream_survives_stops_and_equals_one_fold(spark, tmp_path, monkeypatch):
    path, checkpoint = tmp_path / "rows", str(tmp_path / "checkpoint")
    states = [
        [{"hash": f"k{k}", "lastRefresh": day(1 + k % 3), "n": 0} for k in range(30)] + [{"hash": "unknown"}],
        [{"hash": f"k{k}", "lastRefresh": day(4), "n": 1} for k in range(0, 30, 7)],
        [{"hash": "late", "lastRefresh": day(4), "n": 2}, {"hash": "k3", "lastRefresh": day(5), "n": 2}],
    ]
    register_source(spark, "listed_stream", listed(path))
    store, held = Snapshots(spark, str(tmp_path / "store"), buckets=2), {}
    for n, state in enumerate(states):
        held |= {r["hash"]: r for r in state}
        listed(path, *held.values())
        with monkeypatch.context() as patch:
            patch.setattr(Snapshots, "publish", lambda *_: 1 / 0)
            with pytest.raises(Exception, match="division by zero"):
                start_source_stream(store, "listed_stream", checkpoint, settings={"top": 4}).awaitTermination()
        assert store.head().version == n
        start_source_stream(store, "listed_stream", checkpoint, settings={"top": 4}).awaitTermination()
        assert store.head().version == n + 1
        start_source_stream(store, "listed_stream", checkpoint, settings={"top": 4}).awaitTermination()
        assert store.head().version == n + 1
    register_source(spark, "listed_whole", Listed(str(path)))
    whole = fold(to_landing(unwrap(spark.read.format("listed_whole").load())))
    assert shown(store.landing()) == shown(whole.select("hash", "raw", "lastrefresh")) and store.flat().count() == 32


def test_a_page_opens_its_own_file_and_little_of_it(spark, tmp_path):
    import workload.source as source

    texts = spark.range(0, 6000, 1, 6).select(
        F.col("id").alias("seq"),
        F.concat(F.lit('{"hash":"'), "id", F.lit('","pad":"'), *(F.sha2(F.concat("id", F.lit(f" {k}")), 256) for k in range(10)), F.lit('"}')).alias("value"),
        F.when(F.col("id") >= 100, F.timestamp_micros(F.col("id") * 1000000)).alias("refresh"),
    )
    folder = str(tmp_path / "source")
    for state in ("1", "2"):
        source.land_source(texts, f"{folder}/{state}", ["refresh", "seq"])
    client = source.FolderClient(folder)

    def hashes(skip, top, since=None):
        return [int(r["hash"]) for r in json.loads(client.fetch(skip, top, since))[ENVELOPE_KEY]]

    assert hashes(0, 1000) == [*range(1000)] and hashes(5990, 1000) == [*range(5990, 6000)] and hashes(6000, 1) == []
    for since, first in (("1970-01-01T00:00:00+00:00", 100), ("1970-01-01T00:50:00+00:00", 3000), ("1970-01-02T00:00:00+00:00", 6000)):
        assert hashes(0, 500, since) == [*range(first, min(first + 500, 6000))]
    (path,) = {source._newest(folder)}
    assert path.endswith("/2")
    files = [p for p in Path(path, "rows").iterdir() if p.suffix == ".parquet"]
    groups = [pq.read_metadata(f).row_group(k).num_rows for f in files for k in range(pq.read_metadata(f).num_row_groups)]
    assert sum(groups) == 6000 and max(groups) <= 2500
    # A page of the first file is found although the files behind it are gone.
    mine = {h.file for h in source._held(path) if h.first < 10}
    for f in files:
        if f.name not in mine:
            f.write_bytes(b"")
    source._records.cache_clear()
    assert hashes(0, 10) == [*range(10)]


@pytest.mark.parametrize("n", [1, 5119, 5120, 5121, 1_000_003])
@pytest.mark.parametrize("open_end", [False, True])
def test_a_long_source_has_a_bounded_number_of_tasks(n, open_end):
    from tidemark.sources.paged import MOST_TASKS

    parts = Requests(None, Settings(top=5, pages_per_task=2)).ranges(n, None, open_end)
    assert len(parts) <= MOST_TASKS and all(p.first % 10 == 0 for p in parts)
    assert [p.end for p in parts[:-1]] == [p.first for p in parts[1:]] and parts[-1].end == (None if open_end else n)
    assert n > 10 * MOST_TASKS or len(parts) == -(-n // 10)


def test_a_source_is_landed_by_one_write(spark, tmp_path):
    """Records are rendered once they are in order, and written nowhere else; ties and unknown refreshes keep their places."""
    import workload.source as source
    from tidemark.session import noting_scratch

    rows = spark.range(0, 5000, 1, 5).select(F.col("id"), F.when(F.col("id") % 3 != 0, F.timestamp_seconds(F.col("id") % 7)).alias("refresh"))
    with noting_scratch() as paths:
        source.land_source(rows, str(tmp_path / "s" / "1"), ["refresh", "id"], lambda r: r.select("refresh", F.to_json(F.struct("id")).alias("value")))
    assert paths == []
    order = [k for _, k in sorted((k % 7 if k % 3 else -1, k) for k in range(5000))]
    client = source.FolderClient(str(tmp_path / "s"))
    found = [r["id"] for skip in range(0, 6000, 700) for r in json.loads(client.fetch(skip, 700, None))[ENVELOPE_KEY]]
    assert found == order and json.loads(client.fetch(5000, 10, None))[ENVELOPE_KEY] == []
    since = "1970-01-01T00:00:05+00:00"
    assert [r["id"] for r in json.loads(client.fetch(0, 1000, since))[ENVELOPE_KEY]] == [k for k in order if k % 3 and k % 7 >= 5][:1000]
