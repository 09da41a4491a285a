import json
import os
from datetime import datetime, timedelta

import pytest
from helpers import page, records, shown, utc
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.checks import unparsable
from tidemark.operators.landing import fold, to_landing
from tidemark.plans import Snapshots
from tidemark.schema import ENVELOPE_KEY, PAGE_CAP
from tidemark.sources import extract_all, extract_pages, incremental, page as page_of
from tidemark.sources import numbered, page_folder, pages, read_lines, read_pages, unwrap
from tidemark.streaming import start_stream


def hashes(recs):
    rows = recs.select("ord", F.variant_get("rec", "$.hash", "string").alias("h")).orderBy("ord").collect()
    return [r.h for r in rows]


def test_full_short_empty_missing_and_bare_pages(spark, tmp_path):
    page(tmp_path, 0, *({"hash": f"a{i:04d}"} for i in range(PAGE_CAP)))
    page(tmp_path, 1, {"hash": "b0"}, {"hash": "b1"})
    page(tmp_path, 2)
    page(tmp_path, 3, body=json.dumps({"metadata": [{"hash": "no"}]}))
    page(tmp_path, 4, body=json.dumps([{"hash": "c0"}]))
    found = hashes(unwrap(read_pages(spark, str(tmp_path))))
    assert found == [f"a{i:04d}" for i in range(PAGE_CAP)] + ["b0", "b1", "c0"]


def test_arrival_order_is_page_number_then_position(spark, tmp_path):
    for n in (10, 2, 1):
        page(tmp_path, n, {"hash": f"{n}-first"}, {"hash": f"{n}-second"})
    found = hashes(unwrap(read_pages(spark, str(tmp_path))))
    assert found == ["1-first", "1-second", "2-first", "2-second", "10-first", "10-second"]


def test_page_that_is_not_json_raises(spark, tmp_path):
    page(tmp_path, 0, body="{not json")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        unwrap(read_pages(spark, str(tmp_path))).collect()


def test_page_file_without_a_number_raises(spark, tmp_path):
    (tmp_path / "latest.json").write_text(json.dumps({ENVELOPE_KEY: [{"hash": "a"}]}))
    with pytest.raises(PySparkException, match="no sequence number"):
        unwrap(read_pages(spark, str(tmp_path))).collect()


def test_pages_per_line_and_blank_lines(spark, tmp_path):
    lines = [json.dumps({ENVELOPE_KEY: [{"hash": f"{i}a"}, {"hash": f"{i}b"}]}) for i in range(3)]
    (tmp_path / "part-00001.txt").write_text("\n\n".join(lines) + "\n")
    (tmp_path / "part-00000.txt").write_text(json.dumps({ENVELOPE_KEY: [{"hash": "first"}]}))
    found = hashes(unwrap(read_pages(spark, str(tmp_path), per_line=True)))
    assert found == ["first", "0a", "0b", "1a", "1b", "2a", "2b"]


def test_lines_keep_file_order_across_splits(spark, tmp_path, with_conf):
    with_conf(spark__sql__files__maxPartitionBytes="512", spark__sql__files__openCostInBytes="0")
    for n in range(3):
        rows = (json.dumps({"hash": f"{n}-{i:04d}", "fill": "x" * 40}) for i in range(200))
        (tmp_path / f"dump-{n}.jsonl").write_text("\n".join(rows))
    lines = read_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 10
    assert hashes(lines) == [f"{n}-{i:04d}" for n in range(3) for i in range(200)]


def test_incremental_is_inclusive_and_drops_unknown_refreshes(spark):
    recs = records(
        spark,
        {"hash": "old", "lastRefresh": "2024-01-01T23:59:59.999Z"},
        {"hash": "boundary", "lastRefresh": "2024-01-02T00:00:00.000Z"},
        {"hash": "offset", "lastRefresh": "2024-01-01T23:30:00-05:00"},
        {"hash": "unknown", "lastRefresh": None},
        {"hash": "empty", "lastRefresh": ""},
    )
    assert hashes(incremental(recs, utc(2024, 1, 2))) == ["boundary", "offset"]
    assert hashes(incremental(recs, datetime(2024, 1, 2))) == ["boundary", "offset"]
    assert len(hashes(incremental(recs, None))) == 5


def test_page_window_and_its_size(spark):
    rows = spark.range(2500).select(F.lit(1).alias("same"), F.col("id"))
    got = [(r.position, r.id) for r in page_of(rows, 100, PAGE_CAP, ["same", "id"]).collect()]
    assert got == [(i, i) for i in range(100, 100 + PAGE_CAP)]
    assert [r.id for r in page_of(rows, 2490, 1000, ["same", "id"]).collect()] == list(range(2490, 2500))
    assert page_of(rows, 2500, 1000, ["same", "id"]).collect() == []
    for top in (0, PAGE_CAP + 1, 5000):
        with pytest.raises(ValueError, match="a page holds"):
            page_of(rows, 0, top, ["same", "id"])


def test_shallow_and_deep_pages_are_in_order(spark, with_conf):
    with_conf(spark__sql__shuffle__partitions="9", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 45000, 1, 7).select((F.col("id") * 37 % 45000).alias("id"))
    for skip in (0, 17, 44000, 44990):
        got = [r.id for r in page_of(rows, skip, 900, ["id"]).collect()]
        assert got == list(range(skip, min(skip + 900, 45000)))


def test_every_row_gets_its_position_and_page(spark, with_conf):
    with_conf(
        spark__sql__shuffle__partitions="9",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__files__maxRecordsPerFile="100",
    )
    rows = spark.range(0, 4321, 1, 5).select((F.col("id") * 7 % 4321).alias("id"), F.lit("x").alias("other"))
    assert sorted((r.position, r.id) for r in numbered(rows, ["id"]).collect()) == [(i, i) for i in range(4321)]
    placed = {(r.page_seq, r.pos): r.id for r in pages(rows, 1000, ["id"]).collect()}
    assert placed == {(i // 1000, i % 1000): i for i in range(4321)}


def test_page_folder_opens_every_file_unless_asked_otherwise(spark, tmp_path):
    page(tmp_path, 0, {"hash": "before", "lastRefresh": "2024-03-01T00:00:00Z"}, {"hash": "ahead", "lastRefresh": "2024-05-01T00:00:00Z"})
    page(tmp_path, 1, {"hash": "after", "lastRefresh": "2024-05-01T00:00:00Z"})
    for number, landed in ((0, utc(2024, 3, 2)), (1, utc(2024, 5, 2))):
        stamp = landed.timestamp()
        os.utime(tmp_path / f"page-{number:06d}.json", (stamp, stamp))
    assert hashes(page_folder(spark, str(tmp_path))(utc(2024, 4, 1))) == ["ahead", "after"]
    source = page_folder(spark, str(tmp_path), slack=timedelta(hours=1))
    assert hashes(source(None)) == ["before", "ahead", "after"]
    assert hashes(source(utc(2024, 4, 1))) == ["after"]
    assert hashes(source(utc(2030, 1, 1))) == []


def test_dates_in_names_do_not_hide_the_page_number(spark, tmp_path):
    for day_, hour in (("2024-01-21", 2), ("2024-01-20", 1)):
        for n in (2, 10, 1):
            file = tmp_path / f"{day_}-page-{n:06d}.json"
            file.write_text(json.dumps({ENVELOPE_KEY: [{"hash": f"{day_[-2:]}-{n}"}]}))
            os.utime(file, (hour * 3600 + 11 - n, hour * 3600 + 11 - n))
    assert hashes(unwrap(read_pages(spark, str(tmp_path)))) == ["20-1", "20-2", "20-10", "21-1", "21-2", "21-10"]


def test_drops_of_equal_part_numbers_keep_their_order(spark, tmp_path):
    """What Spark writes in one go is one series; a later write is a later one, whatever its part numbers."""
    for step in (0, 1, 2):
        rows = [(step * 100 + i, json.dumps({ENVELOPE_KEY: [{"hash": f"{step}-{i:02d}"}]})) for i in range(9)]
        frame = spark.createDataFrame(rows, "n int, value string").repartitionByRange(3, "n").sortWithinPartitions("n")
        frame.select("value").write.mode("append").text(str(tmp_path / "drops"))
    found = hashes(unwrap(read_pages(spark, str(tmp_path / "drops"), per_line=True)))
    assert found == [f"{step}-{i:02d}" for step in range(3) for i in range(9)]


@pytest.mark.parametrize("per_line", [False, True])
def test_files_without_an_order_are_refused(spark, tmp_path, per_line):
    for folder in ("a", "b"):
        page(tmp_path / folder, 1, {"hash": folder})
    with pytest.raises(PySparkException, match="without an order"):
        unwrap(read_pages(spark, str(tmp_path / "*"), per_line)).collect()


def test_permissive_reading_leaves_out_what_is_not_json(spark, tmp_path):
    page(tmp_path, 0, {"hash": "a"})
    page(tmp_path, 1, body="{not json")
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "dump-0.jsonl").write_text('{"hash": "x"}\nnot json\n{"hash": "y"}\n')
    pages_ = read_pages(spark, str(tmp_path / "*.json"))
    assert hashes(unwrap(pages_, strict=False)) == ["a"]
    assert [r.value for r in unparsable(pages_).collect()] == ["{not json"]
    assert hashes(read_lines(spark, str(tmp_path / "lines"), strict=False)) == ["x", "y"]
    recs = records(spark, {"hash": "a", "lastRefresh": "soon"}, {"hash": "b", "lastRefresh": "2024-01-02T00:00:00Z"})
    assert hashes(incremental(recs, utc(2024, 1, 1), strict=False)) == ["b"]


def test_extract_pages_fetches_every_offset_range(spark):
    total = 2345

    def fetch(skip, top):
        rows = [{"hash": str(i)} for i in range(skip, min(skip + top, total))]
        return json.dumps({"PublicAssistanceFundedProjectsDetails": rows})

    fetched = extract_pages(spark, fetch, 0, 24, top=100, pages_per_task=4)
    assert fetched.rdd.getNumPartitions() == 6
    assert hashes(unwrap(fetched)) == [str(i) for i in range(total)]
    with pytest.raises(ValueError, match="a page holds"):
        extract_pages(spark, fetch, 1, 1, top=99999)


@pytest.mark.parametrize("total, wave, waves", [(0, 2, 1), (150, 2, 1), (400, 2, 3), (450, 3, 2)])
def test_extract_all_stops_at_a_short_page(spark, tmp_path, total, wave, waves):
    def fetch(skip, top):
        rows = [{"hash": str(i)} for i in range(skip, min(skip + top, total))]
        return json.dumps({"PublicAssistanceFundedProjectsDetails": rows})

    path = tmp_path / "pages"
    found = extract_all(spark, fetch, str(path), top=100, wave=wave)
    assert hashes(unwrap(found)) == [str(i) for i in range(total)]
    assert len(list(path.glob("wave=*"))) == waves


def landed_at(folder, name, second, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(list(rows)))
    os.utime(folder / name, (1_700_000_000 + second,) * 2)


def last_of_a(spark, folder, **options):
    return fold(to_landing(page_folder(spark, str(folder), **options)(None))).select(F.variant_get("raw", "$.n", "int").alias("n")).first().n


def test_series_that_landed_at_one_instant_have_no_order(spark, tmp_path):
    """Random ids of writes, and days copied in one second: refused, or ordered by name when asked."""
    for folder, names in (("ids", ("part-00000-zzz-c000.json", "part-00000-aaa-c000.json")), ("days", ("2024-01-21-page-1", "2024-01-22-page-1"))):
        for n, name in enumerate(names):
            landed_at(tmp_path / folder, name, 0, {"hash": "a", "n": n})
        with pytest.raises(PySparkException, match="without an order between them: .* and "):
            last_of_a(spark, tmp_path / folder)
    assert last_of_a(spark, tmp_path / "days", by_name=True) == 1
    assert last_of_a(spark, tmp_path / "ids", by_name=True) == 0


def test_streams_and_batches_agree_where_series_overlap(spark, tmp_path):
    for second, name in enumerate(("a-1", "b-1", "a-2", "c-7")):
        landed_at(tmp_path / "pages", f"{name}.json", second, {"hash": "a", "n": second}, {"hash": name, "n": second})
    stores = []
    for files in (1, 2, None):
        store = Snapshots(spark, str(tmp_path / f"store-{files}"), buckets=2)
        start_stream(store, str(tmp_path / "pages"), str(tmp_path / f"checkpoint-{files}"), files_per_batch=files).awaitTermination()
        stores.append(shown(store.landing()))
    batch = fold(to_landing(page_folder(spark, str(tmp_path / "pages"))(None)))
    assert stores[0] == stores[1] == stores[2] == shown(batch.select("hash", "raw", "lastrefresh"))
    assert last_of_a(spark, tmp_path / "pages") == 3


def test_a_file_that_lands_before_its_predecessor(spark, tmp_path):
    """Alone, a series comes by place; among others that overlap it nothing says which file came first."""
    landed_at(tmp_path / "alone", "a-2.json", 0, {"hash": "a", "n": 2})
    landed_at(tmp_path / "alone", "a-1.json", 5, {"hash": "a", "n": 1})
    assert last_of_a(spark, tmp_path / "alone") == 2
    landed_at(tmp_path / "alone", "b-1.json", 9, {"hash": "a", "n": 3})
    assert last_of_a(spark, tmp_path / "alone") == 3
    landed_at(tmp_path / "alone", "b-0.json", 3, {"hash": "a", "n": 4})
    with pytest.raises(PySparkException, match="without an order"):
        last_of_a(spark, tmp_path / "alone")
