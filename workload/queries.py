"""Every registered query: a callable ``(spark, sf_dir) -> DataFrame`` per operator.

Instants are returned without a zone and records as JSON text, so that results compare by value.
"""

import uuid
from datetime import date, datetime

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import instant, quoted_iso
from tidemark.operators import checks, flat as flat_ops, landing as landing_ops, mark as mark_ops, serve
from tidemark.plans import Snapshots, rollups, run_cycle
from tidemark.schema import create_tables
from tidemark.session import prepare, scratch_path, small_splits, whole_variants, written
from tidemark.sources import incremental, page, page_folder, pages, parse_records, register_source, unwrap
from tidemark.streaming import start_source_stream, start_stream
from workload import inputs
from workload.inputs import AS_OF
from workload.source import FolderClient, land_source

# The first part of the events is already in landing; the second part is the new batch.
SPLIT = datetime(2024, 1, 16)

# A day after every refresh of the events.
LATER = datetime(2024, 3, 1, 8)

# Three drops of page files for the replay: events before, between and after these instants.
DROPS = (datetime(2024, 1, 11), datetime(2024, 1, 21))


def plain(df: DataFrame) -> DataFrame:
    columns: list[Column] = []
    for f in df.schema:
        value = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.VariantType):
            value = F.to_json(value)
        columns.append(value.alias(f.name))
    return df.select(*columns)


# -- ingest ------------------------------------------------------------------------------------


def landing_build(spark: SparkSession, sf: str) -> DataFrame:
    return plain(landing_ops.to_landing(inputs.records(spark, sf)).drop("ord"))


def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records of anonymous events lose their key in three ways; all are rejected and counted."""
    members = inputs.table(spark, sf, "events")
    key = F.expr(
        "case event_type when 'error' then '0' when 'click' then '\"\"' when 'view' then 'null'"
        " else concat('\"', user_id, '\"') end"
    )
    texts = members.select(F.concat(F.lit('{"hash":'), key, F.lit("}")).alias("value"), F.col("event_id").alias("seq"))
    keyed = landing_ops.keyed(parse_records(texts, "seq"))
    return keyed.agg(
        F.count(F.lit(1)).alias("received"),
        F.count("hash").alias("sent"),
        F.count_if(F.col("hash").isNull()).alias("rejected"),
    )


def envelope_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    rows = unwrap(inputs.pages_of(inputs.record_texts(spark, sf)))
    return rows.select(
        F.col("ord.page_seq").alias("page_seq"),
        F.col("ord.pos").alias("pos"),
        F.variant_get("rec", "$.hash", "string").alias("hash"),
    )


def flatten_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of every record, in one pass per record."""
    return plain(flat_ops.flatten_whole(landing_ops.to_landing(inputs.records(spark, sf))).drop("raw"))


def fold_last_write(spark: SparkSession, sf: str) -> DataFrame:
    return plain(landing_ops.fold(inputs.event_landing(spark, sf)))


def fold_latest_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return plain(landing_ops.fold(inputs.event_landing(spark, sf), landing_ops.LATEST_REFRESH))


def _split(spark: SparkSession, sf: str, policy: str) -> tuple[DataFrame, DataFrame]:
    rows = inputs.event_landing(spark, sf)
    before = F.col("ts") < instant(SPLIT)
    return landing_ops.fold(rows.where(before), policy), landing_ops.fold(rows.where(~before), policy)


def landing_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _split(spark, sf, landing_ops.ARRIVAL)
    return plain(landing_ops.upsert(old, new))


def landing_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _split(spark, sf, landing_ops.LATEST_REFRESH)
    return plain(landing_ops.upsert(old, new, landing_ops.LATEST_REFRESH))


# -- marks and extracts ------------------------------------------------------------------------


def landing_count(spark: SparkSession, sf: str) -> DataFrame:
    return mark_ops.row_count(landing_ops.fold(inputs.event_landing(spark, sf)))


def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return plain(mark_ops.high_water_mark(landing_ops.fold(inputs.event_landing(spark, sf))))


def _marks(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    """The next mark over all events, asked for on a day before and on a day after the latest refresh."""
    landing, out = inputs.event_landing(spark, sf), None
    for name, as_of in (("before", AS_OF), ("after", LATER)):
        mark = plain(mark_ops.next_mark(landing, as_of, policy)).withColumn("asked", F.lit(name))
        out = mark if out is None else out.unionByName(mark)
    return out


def next_mark_guard(spark: SparkSession, sf: str) -> DataFrame:
    return _marks(spark, sf, mark_ops.TODAY_GUARD)


def next_mark_resume(spark: SparkSession, sf: str) -> DataFrame:
    return _marks(spark, sf, mark_ops.RESUME)


def mark_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The mark as the text a remote source is asked with."""
    landing = landing_ops.fold(inputs.event_landing(spark, sf))
    return mark_ops.next_mark(landing, AS_OF, mark_ops.TODAY_GUARD).select(quoted_iso(F.col("mark")).alias("mark_text"))


def incremental_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = incremental(inputs.event_records(spark, sf), SPLIT)
    return plain(
        found.select(
            F.variant_get("rec", "$.event_id", "bigint").alias("event_id"),
            F.variant_get("rec", "$.hash", "string").alias("hash"),
            F.col("ord.refresh").alias("lastrefresh"),
        )
    )


def page_window(spark: SparkSession, sf: str) -> DataFrame:
    """One page of all folded events; positions tell the order."""
    landing = landing_ops.fold(inputs.event_landing(spark, sf)).select("hash", "lastrefresh")
    return plain(page(landing, 40, 25, ["lastrefresh", "hash"]))


def page_deep(spark: SparkSession, sf: str) -> DataFrame:
    """A page three quarters into the whole published landing table, records without a refresh included."""
    store = inputs.published(spark, sf)
    return plain(store.page(store.landing().count() * 3 // 4, 500))


def _dropped(spark: SparkSession, sf: str, folder: str):
    """Land the events as page files in three drops; yields after each."""
    events, ts = inputs.table(spark, sf, "events"), F.col("ts")
    first, second = (F.lit(str(t)).cast("timestamp_ntz") for t in DROPS)
    for drop in (ts < first, (ts >= first) & (ts < second), ts >= second):
        inputs.land_pages(inputs.pages_of(inputs.event_texts(events.where(drop))), folder)
        yield


def pages_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Events that landed in three drops, read as one batch: the same as one fold over all of them."""
    folder = scratch_path(prepare(spark), "drops")
    for _ in _dropped(spark, sf, folder):
        pass
    landed = page_folder(spark, folder, per_line=True)(None)
    folded = landing_ops.fold(landing_ops.to_landing(landed))
    return plain(folded.select("hash", F.variant_get("raw", "$.event_id", "bigint").alias("event_id"), "lastrefresh"))


def _source(spark: SparkSession, path: str) -> str:
    """A registered source over a folder that ``land_source`` fills; its name is its own."""
    name = f"source_{uuid.uuid4().hex[:12]}"
    register_source(spark, name, FolderClient(path))
    return name


def _land(members: DataFrame, path: str, by_refresh: bool) -> None:
    """Land records as a source in the order of their ids, or of their refreshes and ids; rendered once they are in order."""
    rows = members.withColumn("refresh", F.col("lastRefresh").cast("timestamp"))

    def render(in_order: DataFrame) -> DataFrame:
        return in_order.select("refresh", F.to_json(F.struct(*members.columns), {"ignoreNullFields": "false"}).alias("value"))

    land_source(rows, path, [*(["refresh"] if by_refresh else []), "gmProjectId"], render)


def extract_dump(spark: SparkSession, sf: str) -> DataFrame:
    """All pages of a source of all records, in the order of their keys: offset ranges, each fetched by its own task."""
    path = scratch_path(prepare(spark), "extract")
    _land(inputs.record_members(spark, sf), f"{path}/1", by_refresh=False)
    landed = spark.read.format(_source(spark, path)).option("pagesPerTask", 4).load()
    rows = unwrap(written(landed, "pages"))
    return rows.select(F.col("ord.page_seq").alias("page_seq"), F.variant_get("rec", "$.hash", "string").alias("hash"))


def extract_source(spark: SparkSession, sf: str) -> DataFrame:
    """The records refreshed since an instant, as a source in the order of refresh pages them."""
    path = scratch_path(prepare(spark), "extract")
    _land(inputs.record_members(spark, sf), f"{path}/1", by_refresh=True)
    landed = spark.read.format(_source(spark, path)).options(since="1996-06-01T00:00:00Z", top=500, pagesPerTask=2).load()
    rows = unwrap(written(landed, "pages"))
    return rows.select(
        F.col("ord.page_seq").alias("page_seq"), F.col("ord.pos").alias("pos"), F.variant_get("rec", "$.hash", "string").alias("hash")
    )


def extract_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A source that changes between three runs of a stream, the second of which is stopped before it publishes.

    Urgent and low records are there at first, then the others come, and at last every hundredth record again, changed.
    The mark, the batch that was stopped and what was loaded by then are in the checkpoint and the tables.
    """
    path = scratch_path(prepare(spark), "extract")
    store = Snapshots(spark, f"{path}/store", inputs.buckets(spark, sf))
    source = _source(spark, f"{path}/source")
    members = inputs.record_members(spark, sf)
    early = F.coalesce(F.col("incidentType").isin("URGENT", "LOW"), F.lit(False))
    later = members.withColumn("lastRefresh", F.when(early, F.col("lastRefresh")).otherwise(F.lit("2024-01-10T00:00:00.000Z")))
    changed = {"lastRefresh": F.lit("2024-01-19T00:00:00.000Z"), "county": F.lit("Updated")}
    again = F.col("gmProjectId") % 100 == 1
    states = (
        members.where(early),
        later,
        later.withColumns({name: F.when(again, value).otherwise(F.col(name)) for name, value in changed.items()}),
    )
    for n, state in enumerate(states):
        _land(state, f"{path}/source/{n}", by_refresh=True)

        def stopped(commit):
            raise ConnectionError("stopped before it publishes")

        if n == 1:
            broken = Snapshots(spark, store.root)
            broken.publish = stopped
            try:
                start_source_stream(broken, source, f"{path}/checkpoint").awaitTermination()
                raise AssertionError("the stream was not stopped")
            except StreamingQueryException as error:
                if "stopped before it publishes" not in str(error):
                    raise
        start_source_stream(store, source, f"{path}/checkpoint").awaitTermination()
    landing = store.landing().select("hash", "lastrefresh", F.variant_get("raw", "$.county", "string").alias("county"))
    return plain(landing.join(store.flat().select("hash", "gmprojectid"), "hash"))


def ingest_permissive(spark: SparkSession, sf: str) -> DataFrame:
    """Pages cut off in the middle and refreshes that are no instants do not stop a permissive load."""
    members = inputs.record_members(spark, sf)
    bad = members.withColumn("lastRefresh", F.expr("if(projectStatus = 'Open', 'soon', lastRefresh)"))
    pages_ = inputs.pages_of(inputs.as_records(bad, "gmProjectId"))
    cut = F.expr("if(page_seq % 3 = 1, substr(value, 1, length(value) - 1), value)")
    landed = landing_ops.to_landing(unwrap(pages_.withColumn("value", cut), strict=False), strict=False)
    return plain(landing_ops.fold(landed).select("hash", "lastrefresh"))


def unparsable_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The pages that such a load leaves out."""
    pages_ = inputs.pages_of(inputs.record_texts(spark, sf))
    cut = F.expr("if(page_seq % 3 = 1, substr(value, 1, length(value) - 1), value)")
    found = checks.unparsable(pages_.withColumn("value", cut))
    return found.select("page_seq", F.size(F.split("value", '"gmProjectId"')).alias("n_parts"))


def paged_dump(spark: SparkSession, sf: str) -> DataFrame:
    """All pages of the whole landing table, in refresh order."""
    landing = inputs.published(spark, sf).landing().select("hash", "lastrefresh")
    return plain(pages(landing, 1000, ["lastrefresh", "hash"]))


# -- change propagation ------------------------------------------------------------------------

_sync_tables: dict[tuple[str, str], tuple[str, str]] = {}


def _landing_and_old_flat(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both tables as written Parquet: all records in landing, an earlier state of them in flat.

    Pending projects are new to flat. Of the others, urgent ones hold an older refresh, high
    ones none, medium ones a newer one, and the rest the same as landing.
    """
    key = (prepare(spark).sparkContext.applicationId, sf)
    if key not in _sync_tables:
        paths = scratch_path(spark, "landing"), scratch_path(spark, "flat")
        with whole_variants(spark):
            landing_ops.to_landing(inputs.records(spark, sf)).drop("ord").write.parquet(paths[0])
        flat = flat_ops.flatten_whole(spark.read.parquet(paths[0]))
        refresh = F.expr(
            "case incidenttype when 'URGENT' then lastrefresh - interval 1 day when 'HIGH' then null"
            " when 'MEDIUM' then lastrefresh + interval 1 day else lastrefresh end"
        )
        before = flat.where(F.col("projectstatus") != "Pending").withColumn("lastrefresh", refresh)
        # Old amounts differ, so that a replaced row is told from a kept one.
        amount = (F.col("projectamount") + 1).cast("decimal(38,10)")
        with small_splits(spark), whole_variants(spark):
            before.withColumn("projectamount", amount).write.parquet(paths[1])
        _sync_tables[key] = paths
    landing, flat = _sync_tables[key]
    return spark.read.parquet(landing), spark.read.parquet(flat)


def _changed(spark: SparkSession, sf: str, null_is_oldest: bool = False) -> DataFrame:
    landing, flat = _landing_and_old_flat(spark, sf)
    return flat_ops.changed_keys(landing.select("hash", "lastrefresh"), flat, null_is_oldest)


def changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_changed(spark, sf))


def changed_rows_null_oldest(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_changed(spark, sf, null_is_oldest=True))


def flat_sync(spark: SparkSession, sf: str) -> DataFrame:
    landing, flat = _landing_and_old_flat(spark, sf)
    keys = written(_changed(spark, sf), "changed")
    return plain(flat_ops.sync(flat, landing, keys).drop("raw"))


def sync_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return flat_ops.change_counts(_changed(spark, sf))


# -- whole cycles ------------------------------------------------------------------------------


def cycle_published(spark: SparkSession, sf: str) -> DataFrame:
    """The flat table that one load cycle over all records published."""
    return plain(inputs.published(spark, sf).flat().drop("raw"))


def replace_load(spark: SparkSession, sf: str) -> DataFrame:
    """Load events, then replace everything by the records: nothing of the events remains."""
    store = Snapshots(spark, scratch_path(prepare(spark), "replace"), inputs.buckets(spark, sf))
    events, records = inputs.event_records(spark, sf), inputs.records(spark, sf)
    run_cycle(store, lambda mark: incremental(events, mark), AS_OF)
    run_cycle(store, lambda mark: incremental(records, mark), AS_OF, mode="replace")
    return plain(store.landing().join(store.flat().select("hash", "stateabbr", "projectamount"), "hash").drop("raw"))


def _replay(spark: SparkSession, sf: str, **options) -> Snapshots:
    """Events land as page files in three drops; a stream loads each drop up to the present."""
    root = scratch_path(prepare(spark), "replay")
    store = Snapshots(spark, f"{root}/store", inputs.buckets(spark, sf))
    for _ in _dropped(spark, sf, f"{root}/pages"):
        start_stream(store, f"{root}/pages", f"{root}/checkpoint", per_line=True, **options).awaitTermination()
    return store


def cycle_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Landing after the replay: the same as one fold over all events."""
    return plain(
        _replay(spark, sf).landing().select(
            "hash",
            F.variant_get("raw", "$.event_id", "bigint").alias("event_id"),
            F.variant_get("raw", "$.props.k", "int").alias("k"),
            "lastrefresh",
        )
    )


def load_totals(spark: SparkSession, sf: str) -> DataFrame:
    """What each version of the replay loaded, with the running total."""
    return _replay(spark, sf).history().select("version", "sent", "rejected", "distinct_keys", "inserted", "total_sent")


def load_totals_landing_first(spark: SparkSession, sf: str) -> DataFrame:
    """The same with landing published before flat: records count once, in landing's version."""
    history = _replay(spark, sf, landing_first=True).history()
    return history.select("version", "sent", "rejected", "distinct_keys", "inserted", "total_sent")


def cycle_update(spark: SparkSession, sf: str) -> DataFrame:
    """A small cycle on a large published store: every hundredth record comes again, refreshed and changed."""
    store = inputs.copied(inputs.published(spark, sf), scratch_path(spark, "updated"))
    members = inputs.record_members(spark, sf).where("gmProjectId % 100 = 1")
    changed = members.withColumns({"lastRefresh": F.lit("2024-01-19T00:00:00Z"), "county": F.lit("Updated")})
    batch = parse_records(inputs.as_records(changed, "gmProjectId"), "seq")
    run_cycle(store, lambda mark: incremental(batch, mark), AS_OF)
    both = store.landing().select("hash", "lastrefresh", F.variant_get("raw", "$.county", "string").alias("county"))
    return plain(both.join(store.flat().select("hash", F.col("county").alias("flat_county"), "gmprojectid"), "hash"))


def absent_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Before any load both tables read as empty, and no record is known: the given orders all are new."""
    store = Snapshots(spark, scratch_path(prepare(spark), "absent"), inputs.buckets(spark, sf))
    orders = inputs.table(spark, sf, "orders").select(F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("hash"))
    landing, flat = store.landing(), store.flat()
    return orders.agg(F.count(F.lit(1)).alias("orders")).crossJoin(
        orders.join(landing, "hash", "left_anti").agg(F.count(F.lit(1)).alias("not_in_landing"))
    ).crossJoin(flat.agg(F.count(F.lit(1)).alias("flat_rows"), F.max("lastrefresh").cast("string").alias("flat_mark")))


def empty_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A cycle that is sent only records without a key publishes nothing and counts them."""
    store = inputs.copied(inputs.published(spark, sf), scratch_path(spark, "empty"))
    before = store.head()
    keyless = inputs.record_members(spark, sf).withColumn("hash", F.lit(""))
    batch = parse_records(inputs.as_records(keyless, "gmProjectId"), "seq")
    report = run_cycle(store, lambda mark: batch, AS_OF)
    same = store.head() == before
    return store.landing().agg(F.count(F.lit(1)).alias("landing")).select(
        "landing", F.lit(report.rejected).cast("long").alias("rejected"), F.lit(report.sent).cast("long").alias("sent"), F.lit(same).alias("same")
    )


def failed_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """A cycle that meets a value it must refuse leaves the published tables as they were."""
    store = inputs.copied(inputs.published(spark, sf), scratch_path(spark, "failed"))
    bad = inputs.record_members(spark, sf).withColumns({"lastRefresh": F.lit("2024-01-19T00:00:00Z"), "pwNumber": F.lit("many")})
    batch = parse_records(inputs.as_records(bad, "gmProjectId"), "seq")
    try:
        run_cycle(store, lambda mark: batch, AS_OF)
        raise AssertionError("the value was accepted")
    except PySparkException as refused:
        if "CAST_INVALID_INPUT" not in str(refused):
            raise
    return plain(store.flat().select("hash", "lastrefresh", "pwnumber"))


def created_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The typed tables under their created names, filled with what was published."""
    name = uuid.uuid4().hex[:12]
    store = inputs.published(spark, sf)
    create_tables(prepare(spark), f"landing_{name}", f"flat_{name}")
    store.fill_tables(f"landing_{name}", f"flat_{name}")
    flat = spark.table(f"flat_{name}").select("hash", "stateabbr", "projectamount")
    return flat.join(spark.table(f"landing_{name}").select("hash", "lastrefresh"), "hash").transform(plain)


# -- reports -----------------------------------------------------------------------------------


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.published(spark, sf).flat()


def refresh_range(spark: SparkSession, sf: str) -> DataFrame:
    landing = inputs.published(spark, sf).landing()
    found = serve.slice_by(landing, lastrefresh=(datetime(1997, 1, 1), datetime(1997, 12, 31, 12)))
    return plain(found.select("hash", "lastrefresh"))


def json_contains(spark: SparkSession, sf: str) -> DataFrame:
    landing = landing_ops.to_landing(inputs.event_records(spark, sf))
    found = serve.containing(landing, {"event_type": "purchase", "props": {"k": 42}})
    return found.select(F.variant_get("raw", "$.event_id", "bigint").alias("event_id"), "hash")


def json_contains_landing(spark: SparkSession, sf: str) -> DataFrame:
    landing = inputs.published(spark, sf).landing()
    pattern = {"projectSize": "Large", "disasterNumber": 77, "county": None}
    return serve.containing(landing, pattern).select("hash")


def json_contains_flat(spark: SparkSession, sf: str) -> DataFrame:
    found = serve.containing(_flat(spark, sf), {"stateAbbreviation": "NATION_7", "projectSize": "Large", "countyCode": "007"})
    return found.select("hash", "stateabbr", "projectsize")


def slice_state(spark: SparkSession, sf: str) -> DataFrame:
    return serve.slice_by(_flat(spark, sf), stateabbr="NATION_3").select("hash", "stateabbr", "county", "totalobligated")


def slice_incident(spark: SparkSession, sf: str) -> DataFrame:
    found = serve.slice_by(_flat(spark, sf), incidenttype="URGENT")
    return found.select("hash", "incidenttype", "projectstatus", "projectamount")


def slice_disaster(spark: SparkSession, sf: str) -> DataFrame:
    return serve.slice_by(_flat(spark, sf), disasternumber=605).select("hash", "disasternumber", "pwnumber", "projectsize")


def slice_date_range(spark: SparkSession, sf: str) -> DataFrame:
    found = serve.slice_by(_flat(spark, sf), declarationdate=(date(1996, 3, 1), date(1996, 5, 31)))
    return found.select("hash", "declarationdate", "stateabbr")


def slice_state_incident(spark: SparkSession, sf: str) -> DataFrame:
    found = serve.slice_by(_flat(spark, sf), stateabbr="NATION_11", incidenttype="LOW")
    return found.select("hash", "stateabbr", "incidenttype", "federalshare")


def slice_date_state(spark: SparkSession, sf: str) -> DataFrame:
    found = serve.slice_by(_flat(spark, sf), declarationdate=(date(1998, 1, 1), None), stateabbr="NATION_20")
    return found.select("hash", "declarationdate", "stateabbr", "projectamount")


def money_range(spark: SparkSession, sf: str) -> DataFrame:
    found = serve.slice_by(_flat(spark, sf), federalshare=(200000, 250000), totalobligated=(0, None))
    return found.select("hash", "federalshare", "totalobligated")


def money_topk(spark: SparkSession, sf: str) -> DataFrame:
    return serve.top_by(_flat(spark, sf).select("hash", "federalshare", "stateabbr"), "federalshare", 100)


def money_bottomk(spark: SparkSession, sf: str) -> DataFrame:
    return serve.top_by(_flat(spark, sf).select("hash", "totalobligated"), "totalobligated", 50, largest=False)


def project_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One project by its id."""
    return serve.slice_by(_flat(spark, sf), gmprojectid=1000).select("hash", "gmprojectid", "projectamount")


def applicant_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """All projects of one applicant."""
    return serve.slice_by(_flat(spark, sf), gmapplicantid=77).select("hash", "gmapplicantid", "totalobligated")


def project_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    flat = _flat(spark, sf).select("hash", "gmprojectid", "projectamount")
    return serve.lookup(flat, orders, "gmprojectid", "o_orderkey")


def applicant_join(spark: SparkSession, sf: str) -> DataFrame:
    customers = inputs.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    flat = _flat(spark, sf).select("hash", "gmapplicantid", "totalobligated")
    return serve.lookup(flat, customers, "gmapplicantid", "c_custkey", "left")


def bi_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Plain SQL over the published tables, as a report tool would read them."""
    inputs.published(spark, sf).register_views("bi_landing", "bi_flat")
    return prepare(spark).sql(
        "SELECT f.stateabbr, f.projectsize, count(*) AS projects, sum(f.projectamount) AS project_amount,"
        " CAST(max(l.lastrefresh) AS timestamp_ntz) AS last_refresh"
        " FROM bi_flat f JOIN bi_landing l ON l.hash = f.hash GROUP BY f.stateabbr, f.projectsize"
    )


def rollup_state_incident(spark: SparkSession, sf: str) -> DataFrame:
    return serve.rollup_state_incident(_flat(spark, sf))


def rollup_month_state(spark: SparkSession, sf: str) -> DataFrame:
    return serve.rollup_month_state(_flat(spark, sf))


def rollup_status(spark: SparkSession, sf: str) -> DataFrame:
    return serve.rollup_status(_flat(spark, sf))


def rollup_after_update(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rollups brought up to date after a small cycle that moves every hundredth project to another incident and amount."""
    store = inputs.copied(inputs.published(spark, sf), scratch_path(spark, "rolled"))
    rollups.refresh(store)
    members = inputs.record_members(spark, sf).where("gmProjectId % 100 = 1")
    amount = F.when(F.col("gmProjectId") % 3 == 0, None).otherwise(F.col("totalObligated") + 1).cast("decimal(18,2)")
    changed = members.withColumns({"lastRefresh": F.lit("2024-01-19T00:00:00Z"), "incidentType": F.lit("Moved"), "totalObligated": amount})
    batch = parse_records(inputs.as_records(changed, "gmProjectId"), "seq")
    run_cycle(store, lambda mark: batch, AS_OF)
    return rollups.rollup(store, "state_incident")


def topk_disasters(spark: SparkSession, sf: str) -> DataFrame:
    return serve.top_disasters(_flat(spark, sf), 25)


def state_obligated(spark: SparkSession, sf: str) -> DataFrame:
    """From tables to JSON records to landing to typed columns to one total per state."""
    flat = inputs.flat_records(spark, sf)
    return flat.groupBy("stateabbr").agg(
        F.count(F.lit(1)).alias("projects"), F.sum("totalobligated").alias("total_obligated")
    )


# -- checks ------------------------------------------------------------------------------------


def key_violations(spark: SparkSession, sf: str) -> DataFrame:
    return checks.key_violations(inputs.event_landing(spark, sf))


def null_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Landing-shaped events whose users are unknown or whose record is missing, by type."""
    rows = inputs.table(spark, sf, "events").select(
        F.expr("if(event_type = 'signup', null, cast(user_id as string))").alias("hash"),
        F.expr("if(event_type = 'error', null, parse_json(props))").alias("raw"),
        "event_id",
    )
    return checks.null_violations(rows).select("event_id", "hash")


def _bad_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Records with values a strict flatten refuses, chosen by priority and status."""
    members = inputs.record_members(spark, sf)
    bad = members.withColumns(
        {
            "disasterNumber": F.expr(
                "case incidentType when 'URGENT' then '40000' when 'LOW' then 'abc' else string(disasterNumber) end"
            ),
            "declarationDate": F.expr("if(projectStatus = 'Pending', '1996-13-45', declarationDate)"),
            "projectAmount": F.expr("if(projectSize = 'Large', concat(projectAmount, ' USD'), string(projectAmount))"),
            "totalObligated": F.expr("concat(totalObligated, '123456789012')"),
            "mitigationAmount": F.expr(
                "case gmProjectId % 4 when 0 then '1.5E-12' when 1 then '2.00000000000' when 2 then '-12345e-3' else '0e-20' end"
            ),
        }
    )
    return landing_ops.to_landing(parse_records(inputs.as_records(bad, "gmProjectId"), "seq"))


def cast_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every refused value, refreshes included: those of pending projects are no instants."""
    late = inputs.record_members(spark, sf).withColumn("lastRefresh", F.expr("if(projectStatus = 'Pending', 'later', lastRefresh)"))
    late = landing_ops.to_landing(parse_records(inputs.as_records(late, "gmProjectId"), "seq"), strict=False)
    return checks.quarantine(_bad_landing(spark, sf)).unionByName(checks.quarantine(late))


def flatten_permissive(spark: SparkSession, sf: str) -> DataFrame:
    flat = flat_ops.flatten(_bad_landing(spark, sf), strict=False)
    return flat.select("hash", "disasternumber", "declarationdate", "projectamount", "totalobligated")


def rounded_amounts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.rounded_amounts(_bad_landing(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        landing_build,
        reject_counts,
        envelope_unwrap,
        flatten_records,
        fold_last_write,
        fold_latest_refresh,
        landing_upsert,
        landing_upsert_latest,
        landing_count,
        high_water_mark,
        next_mark_guard,
        next_mark_resume,
        mark_filter,
        incremental_scan,
        page_window,
        page_deep,
        pages_fold,
        extract_dump,
        extract_source,
        extract_stream,
        ingest_permissive,
        unparsable_pages,
        paged_dump,
        changed_rows,
        changed_rows_null_oldest,
        flat_sync,
        sync_metrics,
        cycle_published,
        replace_load,
        cycle_replay,
        load_totals,
        load_totals_landing_first,
        cycle_update,
        absent_tables,
        empty_batch,
        failed_cycle,
        created_tables,
        refresh_range,
        json_contains,
        json_contains_landing,
        json_contains_flat,
        slice_state,
        slice_incident,
        slice_disaster,
        slice_date_range,
        slice_state_incident,
        slice_date_state,
        money_range,
        money_topk,
        money_bottomk,
        project_lookup,
        applicant_lookup,
        project_join,
        applicant_join,
        bi_feed,
        rollup_state_incident,
        rollup_month_state,
        rollup_status,
        rollup_after_update,
        topk_disasters,
        state_obligated,
        key_violations,
        null_violations,
        cast_quarantine,
        flatten_permissive,
        rounded_amounts,
    )
}
