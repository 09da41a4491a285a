"""Inputs that Spark derives from the given tables: JSON records, landing rows, a published store."""

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import ENVELOPE_KEY, prepare
from tidemark.functions import iso_instant
from tidemark.operators.flat import flatten
from tidemark.operators.landing import to_landing
from tidemark.plans import Snapshots, curve, run_cycle
from tidemark.schema import PAGE_CAP
from tidemark.session import TASK_ROWS, scratch_path
from tidemark.sources import incremental, parse_records

AS_OF = datetime(2024, 1, 20, 10, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a scan that has fewer splits than cores; larger scans pass as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _iso(instant_ntz: str) -> Column:
    """ISO text of a zone-less timestamp, read as UTC."""
    return iso_instant(F.expr(f"cast({instant_ntz} as timestamp)"))


def record_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with the members of a source record as columns."""
    orders = table(spark, sf_dir, "orders")
    # A record is many times the row it comes from, so rows are spread by their number while they are narrow.
    tasks = -(-orders.count() // TASK_ROWS)
    many = tasks > spark.sparkContext.defaultParallelism
    base = (
        (orders if many else spread(orders))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("amt", F.col("o_totalprice").cast("decimal(18,2)"))
    )
    if many:
        base = base.repartition(tasks, "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    key = F.col("o_orderkey")
    return base.select(
        F.md5(key.cast("string").cast("binary")).alias("hash"),
        F.when(key % 13 != 0, _iso("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)")).alias("lastRefresh"),
        (F.col("o_custkey") % 4000).alias("disasterNumber"),
        _iso("o_orderdate").alias("declarationDate"),
        F.expr("if(o_orderkey % 17 = 0, '', substr(o_orderpriority, 3))").alias("incidentType"),
        (key % 100000).alias("pwNumber"),
        F.concat(F.lit("Order "), key).alias("applicationTitle"),
        F.col("c_name").alias("applicantId"),
        F.col("o_orderstatus").alias("damageCategoryCode"),
        F.concat(F.lit("Category "), "o_orderstatus").alias("damageCategoryDescrip"),
        F.expr("case o_orderstatus when 'F' then 'Closed' when 'O' then 'Open' else 'Pending' end").alias("projectStatus"),
        F.col("c_mktsegment").alias("projectProcessStep"),
        F.expr("if(o_totalprice >= 250000, 'Large', 'Small')").alias("projectSize"),
        F.expr("if(c_nationkey % 5 = 0, null, concat('County ', c_nationkey))").alias("county"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("countyCode"),
        F.col("n_name").alias("stateAbbreviation"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("stateNumberCode"),
        F.col("amt").alias("projectAmount"),
        F.expr("cast(amt * 0.75 as decimal(18,4))").alias("federalShareObligated"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("totalObligated"),
        _iso("o_orderdate + interval 30 days").alias("lastObligationDate"),
        _iso("o_orderdate").alias("firstObligationDate"),
        F.expr("if(o_orderkey % 7 = 0, '', cast(amt as string))").alias("mitigationAmount"),
        key.alias("gmProjectId"),
        F.col("o_custkey").alias("gmApplicantId"),
    )


def as_records(members: DataFrame, order: str) -> DataFrame:
    """Rows to ``(seq, value)``: a JSON text per record; JSON null where a member is NULL."""
    return members.select(
        F.col(order).alias("seq"), F.to_json(F.struct(*members.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(record_members(spark, sf_dir), "gmProjectId")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(record_texts(spark, sf_dir), "seq")


def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records all the way to typed columns, with no table in between."""
    return flatten(to_landing(records(spark, sf_dir)))


def event_texts(events: DataFrame) -> DataFrame:
    """One record per event, keyed by user, so that keys repeat; errors carry no refresh."""
    members = spread(events).select(
        F.col("user_id").cast("string").alias("hash"),
        F.when(F.col("event_type") != "error", _iso("ts")).alias("lastRefresh"),
        "event_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.from_json("props", "k int").alias("props"),
    )
    return as_records(members, "event_id")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(event_texts(table(spark, sf_dir, "events")), "seq")


def event_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing-shaped rows before any fold: ``(hash, raw, lastrefresh, ord)`` and the event time."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("hash"),
        F.parse_json("props").alias("raw"),
        F.expr("if(event_type = 'error', null, cast(ts as timestamp))").alias("lastrefresh"),
        F.col("event_id").alias("ord"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def pages_of(texts: DataFrame, key: str = ENVELOPE_KEY) -> DataFrame:
    """Group records into page bodies ``(page_seq, value)``.

    ``seq`` is unique, so a page of PAGE_CAP consecutive numbers holds at most that many records.
    """
    page_seq = F.expr(f"seq div {PAGE_CAP}").alias("page_seq")
    in_order = F.array_sort(F.collect_list(F.struct("seq", "value")))
    bodies = F.concat_ws(",", F.transform(in_order, lambda r: r["value"]))
    return texts.groupBy(page_seq).agg(F.concat(F.lit(f'{{"{key}":['), bodies, F.lit("]}")).alias("value"))


def land_pages(pages: DataFrame, path: str) -> None:
    """Append page files, one page per line; part numbers and lines follow the page sequence."""
    in_order = pages.repartitionByRange("page_seq").sortWithinPartitions("page_seq")
    in_order.select("value").write.mode("append").text(path)


def copied(store: Snapshots, root: str) -> Snapshots:
    """A store of its own that starts where another one stands: its newest version is written as a first load."""
    copy, head = Snapshots(store.spark, root, store.buckets), store.head()
    loads = {}
    for table in ("landing", "flat"):
        rows = store.read(table, head)
        n_rows = rows.count()
        sample = curve.sampled(rows, n_rows) if table == "flat" else None
        loads[table] = copy.write(table, rows, n_rows * 5 // (4 * max(1, len(head.flat))), sample)
    copy.write_counts(loads["landing"], store.read("landing", head))
    held = {table: {b: [load] for b in getattr(head, table)} for table, load in loads.items()}
    synced = dict.fromkeys(head.flat, loads["landing"])
    copy.publish(replace(head, version=1, **held, synced=synced, late={}))
    return copy


_stores: dict[tuple[str, str], str] = {}


def buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets for a store of the records: one per two million, from the row count in the footers."""
    return max(8, table(spark, sf_dir, "orders").count() // 2_000_000)


def published(spark: SparkSession, sf_dir: str) -> Snapshots:
    """A store holding the records after one load cycle, built once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        root = scratch_path(prepare(spark), "published")
        source = records(spark, sf_dir)
        run_cycle(Snapshots(spark, root, buckets(spark, sf_dir)), lambda mark: incremental(source, mark), AS_OF)
        _stores[key] = root
    return Snapshots(spark, _stores[key])
