"""One load cycle: extract, fold, upsert landing, sync flat, publish both as one version."""

from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import from_micros
from tidemark.operators import flat as flat_ops
from tidemark.operators import landing as landing_ops
from tidemark.operators import mark as mark_ops
from tidemark.plans import curve
from tidemark.plans.snapshots import PAGE_ROWS, PLACE, Commit, Snapshots
from tidemark.schema import LANDING_SCHEMA
from tidemark.session import TASK_ROWS, broadcast_limit, settings, small_shuffles, whole_variants

# Loads that a bucket may hold beside its base; the next one merges them all into a new base.
LIGHT_LOADS = 8

# Tasks that fold a first batch into one bucket, if it is as large as buckets should be; adaptive execution joins small ones.
FIRST_PARTS = 16

# Rows for each core that are merged at once, if buckets are smaller. What a merge shuffles stays on disk until its rows are
# written, so a large table is merged some buckets after the other.
MERGED_AT_ONCE = 10 * TASK_ROWS

# Memory of one broadcast (hash, refresh) row beside the text of its key: row header, pointers, map slot.
_ROW_OVERHEAD = 96


@dataclass(frozen=True)
class CycleReport:
    """Row counts of a cycle and the version it published (unchanged if nothing was new)."""

    version: int
    mark: datetime | None = None
    sent: int = 0  # records with a usable key, repeats included
    rejected: int = 0  # records without one
    distinct_keys: int = 0
    inserted: int = 0  # flat rows
    updated: int = 0


def bucket_of(key: str, buckets: int) -> Column:
    return F.when(F.col(key).isNotNull(), F.pmod(F.hash(key), F.lit(buckets)))


def _rebalanced(df: DataFrame) -> DataFrame:
    """Cluster rows by bucket at write time; adaptive execution splits an oversized bucket."""
    return df.hint("rebalance", "bucket")


def _by_key(df: DataFrame, buckets: int, parts: int = 1) -> DataFrame:
    """``parts`` partitions per bucket, for both sides of a join on the key.

    ``repartition`` places a row by the same hash as ``bucket_of``, and a multiple of the buckets divides each of them, so
    the joined rows already lie in their buckets and are written without another shuffle. Keys are unique on either side,
    hence partitions are even. The result does not depend on it: rows carry their bucket.
    """
    return df.repartition(buckets * parts, "hash")


def _parts(rows: int, buckets: list[int]) -> int:
    """Partitions per bucket that hold so many rows, so that each has about what a task sorts in memory.

    Not fewer rows: each partition is a file, and the more rows lie along the curve in one file, the more of its pages are skipped.
    """
    most = max(1, len(buckets)) * TASK_ROWS
    return max(1, (rows + most // 2) // most)


def _groups(store: Snapshots, buckets: list[int], rows: int) -> list[list[int]]:
    """Buckets that are merged together, of all that so many rows lie in."""
    n = max(1, -(-rows // (MERGED_AT_ONCE * store.spark.sparkContext.defaultParallelism)))
    size = max(1, len(buckets) // n)
    return [buckets[k : k + size] for k in range(0, len(buckets), size)]


def _of(df: DataFrame, buckets: list[int]) -> DataFrame:
    return df.where(F.col("bucket").isin(buckets))


def _folded_by_bucket(df: DataFrame, buckets: int):
    """Settings under which a fold leaves its rows in their buckets, several partitions each, so that they are not shuffled again."""
    spark = df.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    parts = max(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // buckets), FIRST_PARTS if adaptive else 1)
    return small_shuffles(spark, spark__sql__shuffle__partitions=buckets * parts)


def _fits_above(store: Snapshots, base: Commit, table: str, buckets: list[int], rows: int, key_bytes: int, replaced: Callable[[], int]) -> bool:
    """May these rows go on top of what the buckets hold?

    The places they replace must fit a broadcast. They do if the keys of all rows and as many places fit; else the rows that are
    ``replaced`` are counted, which takes keys alone: however many rows are new, nothing has to be merged for them.
    """
    if any(len(getattr(base, table).get(b, [])) > LIGHT_LOADS for b in buckets) or not store.fits_above(base, 0):
        return False
    small = rows * _ROW_OVERHEAD + key_bytes <= broadcast_limit(store.spark)
    return small and store.fits_above(base, rows) or store.fits_above(base, replaced())


def ingest(
    store: Snapshots, base: Commit, records: DataFrame, policy: str = landing_ops.ARRIVAL, strict: bool = True
) -> tuple[Commit, dict[str, int], DataFrame | None]:
    """Fold records ``(rec, ord)`` and upsert them: the unpublished commit, its counts, and its new rows if they are few.

    A small batch is written as one more load of the buckets it touches: of landing, only the keys and
    refreshes of those buckets are read. A large batch, or one that finds a bucket with many
    loads, writes its buckets anew.
    """
    buckets = base.buckets or store.buckets
    # Records without a key fold into one row with a NULL hash, which is counted and left out.
    folded = landing_ops.fold(landing_ops.keyed(records, strict), policy, counted=True)
    folded = folded.withColumn("bucket", bucket_of("hash", buckets))
    first = not base.landing
    if first:
        # The first batch is the table: it is written once, straight into its buckets.
        with _folded_by_bucket(folded, buckets):
            load = store.write("landing", folded)
        batch = store.read_load("landing", load, folded.schema)
        store.write_counts(load, batch)
    else:
        # In the order of buckets, so that a merge of some reads little else.
        with small_shuffles(folded.sparkSession):
            batch = store.stage(folded.sortWithinPartitions("bucket"), "batch")
    per_bucket = (
        batch.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum("n_rows").alias("sent"),
            F.sum(F.octet_length("hash")).alias("key_bytes"),
            F.unix_micros(F.max("lastrefresh")).alias("latest"),
        )
        .collect()
    )
    filled = [r for r in per_bucket if r.bucket is not None]
    counts = {
        "sent": sum(r.sent for r in filled),
        "rejected": sum(r.sent for r in per_bucket if r.bucket is None),
        "distinct_keys": sum(r["keys"] for r in filled),
    }
    if not filled:
        return base, counts, None

    touched = sorted(r.bucket for r in filled)
    latest = {r.bucket: from_micros(r.latest) for r in filled if r.latest is not None}
    if first:
        return replace(base, buckets=buckets, marks=latest).with_load("landing", touched, load), counts, None

    batch = batch.where(F.col("hash").isNotNull()).drop("n_rows")
    marks = {**base.marks, **{b: max(at, base.marks.get(b, at)) for b, at in latest.items()}}
    old = store.read("landing", base, touched, placed=True)

    def n_replaced() -> int:
        # Where the policy may keep old records, what is replaced is not known from keys alone.
        return counts["distinct_keys"] if policy != landing_ops.ARRIVAL else landing_ops.replaced(old, batch, policy).count()

    if _fits_above(store, base, "landing", touched, counts["distinct_keys"], sum(r.key_bytes for r in filled), n_replaced):
        # Only the rows that the batch replaces are looked at, in the tasks that read them.
        met = store.stage(landing_ops.replaced(old, batch, policy), "met")
        resolved = landing_ops.replacing(met, batch, policy).withColumn("bucket", bucket_of("hash", buckets))
        # Less than a page of a bucket is read whole anyway, and columns of members would be more than its records.
        brief = counts["distinct_keys"] < PAGE_ROWS["landing"] * len(touched)
        with whole_variants(store.spark) if brief else nullcontext():
            load = store.write("landing", _rebalanced(resolved))
        replaced = met.count()
        if replaced:
            store.write_replaced(load, met)
        new = store.read_load("landing", load, LANDING_SCHEMA)
        store.write_counts(load, new.withColumn("bucket", bucket_of("hash", buckets)), met)
        commit = replace(base, marks=marks).with_load("landing", touched, load, replaced)
    else:
        # One shuffle of each side, and none for the write.
        new, commit = None, replace(base, marks=marks)
        n_rows = old.count() + counts["distinct_keys"]
        parts = _parts(n_rows, touched)
        for group in _groups(store, touched, n_rows):
            both = (_by_key(df, buckets, parts) for df in (store.read("landing", base, group), _of(batch, group)))
            result = landing_ops.upsert(*both, policy).withColumn("bucket", bucket_of("hash", buckets))
            with settings(store.spark, spark__sql__shuffle__partitions=buckets * parts):
                load = store.write("landing", result)
            commit = commit.with_load("landing", group, load)
            store.write_counts(load, store.read("landing", commit, group))
    # A bucket's latest refresh can have been replaced by an older one only if the batch brought none as late.
    unsure = [b for b in touched if b in base.marks and (b not in latest or latest[b] < base.marks[b])]
    if unsure and policy == landing_ops.ARRIVAL:
        rows = store.read("landing", commit, unsure).groupBy("bucket").agg(F.unix_micros(F.max("lastrefresh")).alias("latest"))
        found = {r.bucket: from_micros(r.latest) for r in rows.collect() if r.latest is not None}
        commit = replace(commit, marks={**{b: at for b, at in marks.items() if b not in unsure}, **found})
    return commit, counts, new


def sync(
    store: Snapshots,
    base: Commit,
    null_is_oldest: bool = False,
    strict: bool = True,
    before: Commit | None = None,
    new: DataFrame | None = None,
) -> tuple[Commit, dict[str, int]]:
    """Bring the flat buckets that lag behind landing up to date; returns the unpublished commit.

    ``new`` holds the landing rows that changed since ``before``. If flat was up to date then, no
    other row can differ, so only their keys are looked up in flat. Otherwise all rows of the lagging
    buckets are compared. Few changed rows become one more load of their buckets; many, or one load too many, and
    the buckets with changes are written anew.
    """
    lagging = base.lagging()
    if not lagging:
        return base, {"inserted": 0, "updated": 0}
    synced = {**base.synced, **{b: base.landing[b][-1] for b in lagging}}
    if not any(b in base.flat for b in lagging):
        # Nothing to compare with: every row is new, and rows already lie in their buckets.
        landing = store.read("landing", base, lagging)
        rows = flat_ops.flatten_whole(landing, strict).withColumn("bucket", bucket_of("hash", base.buckets))
        n_rows = landing.count()
        sample = flat_ops.flatten(curve.sampled(landing, n_rows), strict=False)
        # No more tasks than buckets for the sake of the cores alone: each task writes files of its own, see _parts.
        tasks = min(len(lagging), store.spark.sparkContext.defaultParallelism)
        with settings(store.spark, spark__sql__files__minPartitionNum=tasks, spark__sql__files__openCostInBytes=1 << 16):
            load = store.write("flat", rows, n_rows * 5 // (4 * len(lagging)), sample)
        commit = replace(base, synced=synced).with_load("flat", lagging, load)
        return commit, {"inserted": n_rows, "updated": 0}

    owed = before is None or new is None or before.lagging()
    landing = store.read("landing", base, lagging) if owed else new.withColumn("bucket", bucket_of("hash", base.buckets))
    narrow = store.read("flat", base, lagging, placed=True).select("hash", "lastrefresh", *PLACE)
    if not owed:
        narrow = narrow.join(landing.select("hash"), "hash", "left_semi")
    changed = flat_ops.changed_keys(landing.select("hash", "lastrefresh", "bucket"), narrow, null_is_oldest, PLACE[1:])
    keys = store.stage(changed, "changed")
    per_bucket = (
        keys.groupBy("bucket")
        .agg(
            F.count_if("is_new").alias("inserted"),
            F.count_if(~F.col("is_new")).alias("updated"),
            F.sum(F.octet_length("hash")).alias("key_bytes"),
        )
        .collect()
    )
    counts = {name: sum(r[name] for r in per_bucket) for name in ("inserted", "updated")}
    if not per_bucket:
        return replace(base, synced=synced), counts
    dirty = sorted(r.bucket for r in per_bucket)
    bucket = bucket_of("hash", base.buckets)
    n_changed, key_bytes = sum(counts.values()), sum(r.key_bytes for r in per_bucket)
    if _fits_above(store, base, "flat", dirty, n_changed, key_bytes, lambda: counts["updated"]):
        # Only changed rows are written; the rows they replace are named by their places.
        most = max(r.inserted + r.updated for r in per_bucket)
        if n_changed * _ROW_OVERHEAD + key_bytes <= broadcast_limit(store.spark):
            rows = flat_ops.flatten_whole(landing.join(F.broadcast(keys.select("hash")), "hash", "left_semi"), strict)
            load = store.write("flat", _rebalanced(rows.withColumn("bucket", bucket)), most)
        else:
            # So many rows lie along the curve like a base, and in their buckets after the join.
            parts = _parts(n_changed, dirty)
            taken = _by_key(landing, base.buckets, parts).join(_by_key(keys.select("hash"), base.buckets, parts), "hash", "left_semi")
            sample = flat_ops.flatten(curve.sampled(landing, landing.count()), strict=False)
            with settings(store.spark, spark__sql__shuffle__partitions=base.buckets * parts):
                load = store.write("flat", flat_ops.flatten_whole(taken, strict).withColumn("bucket", bucket), most, sample)
        replaced = counts["updated"]
        if replaced:
            store.write_replaced(load, keys.where(~F.col("is_new")))
        commit = replace(base, synced=synced).with_load("flat", dirty, load, replaced)
    else:
        commit = replace(base, synced=synced)
        n_rows = store.read("landing", base, dirty).count()
        parts = _parts(n_rows, dirty)
        sample = curve.sampled(store.read("flat", base, dirty), n_rows)
        for group in _groups(store, dirty, n_rows):
            rows = store.read("landing", base, group) if owed else _of(landing, group)
            sides = (_by_key(df, base.buckets, parts) for df in (store.read("flat", base, group), rows, _of(keys, group)))
            kept, new_rows = flat_ops.sync_parts(*sides, strict)
            # As many partitions for the joins, or Spark shuffles the rows once for them and again for the buckets.
            with settings(store.spark, spark__sql__shuffle__partitions=base.buckets * parts):
                load = store.write("flat", kept.unionByName(new_rows.withColumn("bucket", bucket)), n_rows * 5 // (4 * len(dirty)), sample)
            commit = commit.with_load("flat", group, load)
    return commit, counts


def publish(store: Snapshots, head: Commit, commit: Commit, counts: dict[str, int]) -> Commit:
    """Publish if anything differs from the head."""
    if commit == head:
        return head
    total = head.total_sent + counts.get("sent", 0)
    return store.publish(replace(commit, version=head.version + 1, counts=counts, total_sent=total))


def run_cycle(
    store: Snapshots,
    source: Callable[[datetime | None], DataFrame],
    as_of: datetime,
    mode: str = "upsert",
    policy: str = landing_ops.ARRIVAL,
    mark_policy: str = mark_ops.RESUME,
    null_is_oldest: bool = False,
    strict: bool = True,
    landing_first: bool = False,
) -> CycleReport:
    """One full cycle.

    ``source(None)`` gives every record and is used once, while landing is empty; ``source(mark)``
    gives the records refreshed at or after the mark. ``mode="replace"`` starts from empty tables;
    any other mode upserts. Readers keep the previous version until the cycle publishes.
    ``landing_first`` publishes landing before the sync, so a refused value holds back flat alone.
    """
    head = store.head()
    empty = {"landing": {}, "flat": {}, "synced": {}, "marks": {}, "late": {}, "buckets": 0}
    base = replace(head, **empty) if mode == "replace" else head
    totals = {"sent": 0, "rejected": 0, "distinct_keys": 0}

    def load(commit: Commit, records: DataFrame) -> tuple[Commit, DataFrame | None]:
        commit, counts, new = ingest(store, commit, records, policy, strict)
        for name in totals:
            totals[name] += counts[name]
        return commit, new

    commit = load(base, source(None))[0] if not base.landing else base
    mark = mark_ops.mark_after(commit.mark(), as_of, mark_policy)
    before = commit
    commit, new = load(commit, source(mark))
    counts = dict(totals)
    if landing_first:
        head = commit = publish(store, head, commit, counts)
        counts = {}
    commit, changed = sync(store, commit, null_is_oldest, strict, before, new)
    done = publish(store, head, commit, {**counts, **changed})
    return CycleReport(version=done.version, mark=mark, **totals, **changed)
