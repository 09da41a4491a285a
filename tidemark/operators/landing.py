"""Landing: key extraction, per-key fold of a batch, keyed upsert."""

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import refresh_instant, usable_key

# Which record of a key wins: the one that arrived last, or the one refreshed last.
ARRIVAL = "arrival"
LATEST_REFRESH = "latest_refresh_wins"


def _check(policy: str) -> None:
    if policy not in (ARRIVAL, LATEST_REFRESH):
        raise ValueError(f"unknown conflict policy: {policy}")


def keyed(records: DataFrame, strict: bool = True) -> DataFrame:
    """``(rec, ord)`` to ``(hash, raw, lastrefresh, ord)``; ``hash`` is NULL on unusable records."""
    rec = F.col("rec")
    return records.select(
        usable_key(rec).alias("hash"), rec.alias("raw"), refresh_instant(rec, strict).alias("lastrefresh"), "ord"
    )


def to_landing(records: DataFrame, strict: bool = True) -> DataFrame:
    """The keyed records without those that carry no usable key."""
    return keyed(records, strict).where(F.col("hash").isNotNull())


def fold(batch: DataFrame, policy: str = ARRIVAL, counted: bool = False) -> DataFrame:
    """One row per key, as if the batch had been upserted row by row in ``ord`` order.

    Last record, and last *known* refresh. Both aggregates reduce to one row per key and task
    before the shuffle, so a key that holds a third of the batch costs no more than any other.
    ``counted`` adds ``n_rows``, the rows of the key.
    """
    _check(policy)
    counts = [F.count(F.lit(1)).alias("n_rows")] if counted else []
    if policy == ARRIVAL:
        rank, refresh = F.col("ord"), F.max_by("lastrefresh", F.when(F.col("lastrefresh").isNotNull(), F.col("ord")))
    else:
        rank, refresh = F.struct("lastrefresh", "ord"), F.max("lastrefresh")
    return batch.groupBy("hash").agg(F.max_by("raw", rank).alias("raw"), refresh.alias("lastrefresh"), *counts)


def _replaces(policy: str) -> Column:
    """Does the new record of a key that exists on both sides replace the old one?"""
    if policy == ARRIVAL:
        return F.lit(True)
    new, old = F.col("new.lastrefresh"), F.col("old.lastrefresh")
    return old.isNull() | (new.isNotNull() & (new >= old))


def _refresh(policy: str) -> Column:
    new, old = F.col("new.lastrefresh"), F.col("old.lastrefresh")
    return F.coalesce(new, old) if policy == ARRIVAL else F.greatest(new, old)


def upsert(old: DataFrame, new: DataFrame, policy: str = ARRIVAL) -> DataFrame:
    """Merge a folded batch into landing: each side is read and shuffled once."""
    _check(policy)
    take = F.col("new.hash").isNotNull() & (F.col("old.hash").isNull() | _replaces(policy))
    both = old.alias("old").join(new.alias("new"), F.col("old.hash") == F.col("new.hash"), "full_outer")
    return both.select(
        F.coalesce("new.hash", "old.hash").alias("hash"),
        F.when(take, F.col("new.raw")).otherwise(F.col("old.raw")).alias("raw"),
        _refresh(policy).alias("lastrefresh"),
    )


def replaced(old: DataFrame, new: DataFrame, policy: str = ARRIVAL) -> DataFrame:
    """The old rows whose keys a folded batch has. Old records are read only where the policy may keep one.

    A batch that fits the broadcast limit meets the old rows in the tasks that read them.
    """
    _check(policy)
    met = old.drop("raw") if policy == ARRIVAL else old
    return met.join(new.select("hash"), "hash", "left_semi")


def replacing(old: DataFrame, new: DataFrame, policy: str = ARRIVAL) -> DataFrame:
    """The rows of a folded batch as they are to stand in landing: combined with the rows they replace.

    Old rows that no batch row meets are not returned. Sides are joined as their sizes suggest.
    """
    pairs = new.alias("new").join(replaced(old, new, policy).alias("old"), F.col("old.hash") == F.col("new.hash"), "left")
    raw = F.col("new.raw")
    if policy != ARRIVAL:
        raw = F.when(F.col("old.hash").isNull() | _replaces(policy), raw).otherwise(F.col("old.raw"))
    return pairs.select(F.col("new.hash").alias("hash"), raw.alias("raw"), _refresh(policy).alias("lastrefresh"))
