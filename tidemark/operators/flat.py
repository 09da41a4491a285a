"""Flat: typed projection of landing, change detection, keyed sync."""

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import member_text, member_texts, typed
from tidemark.schema import FIELD_MAP


def flatten(landing: DataFrame, strict: bool = True) -> DataFrame:
    """The typed projection. Strict: one bad value fails the job. Otherwise it becomes NULL.

    Member by member, so a query over stored landing rows reads only the members it asks for.
    """
    columns = [typed(member_text(F.col("raw"), f.source), f, strict).alias(f.column) for f in FIELD_MAP]
    return landing.select("hash", "lastrefresh", *columns, "raw")


def flatten_whole(landing: DataFrame, strict: bool = True) -> DataFrame:
    """The same projection for a writer that keeps every column: all members in one pass."""
    texts = landing.withColumn("member", member_texts(F.col("raw"), [f.source for f in FIELD_MAP]))
    columns = [
        typed(F.nullif(F.col("member")[f.source], F.lit("")), f, strict).alias(f.column) for f in FIELD_MAP
    ]
    return texts.select("hash", "lastrefresh", *columns, "raw")


def changed_keys(landing: DataFrame, flat: DataFrame, null_is_oldest: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """Keys the flat table lacks or holds an older refresh of: landing's columns, ``is_new`` and flat's ``carried`` columns.

    Pass narrow inputs: the join then shuffles keys and instants, not records. A flat row with
    no refresh is never replaced (NULL compares as unknown) unless ``null_is_oldest``.
    """
    known = flat.select(F.col("hash").alias("flat_hash"), F.col("lastrefresh").alias("flat_refresh"), *carried)
    newer = F.col("lastrefresh") > F.col("flat_refresh")
    if null_is_oldest:
        newer = newer | F.col("flat_refresh").isNull()
    is_new = F.col("flat_hash").isNull()
    return (
        landing.join(known, F.col("hash") == F.col("flat_hash"), "left")
        .where(is_new | (F.col("lastrefresh").isNotNull() & newer))
        .select(*landing.columns, is_new.alias("is_new"), *carried)
    )


def sync_parts(
    flat: DataFrame, landing: DataFrame, keys: DataFrame, strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(kept, replaced)``: flat rows without the changed keys, and those keys flattened anew."""
    hashes = keys.select("hash")
    kept = flat.join(hashes, "hash", "left_anti")
    return kept, flatten_whole(landing.join(hashes, "hash", "left_semi"), strict)


def sync(flat: DataFrame, landing: DataFrame, keys: DataFrame, strict: bool = True) -> DataFrame:
    """The flat table after the sync: only changed records are flattened, and all their columns are new."""
    kept, replaced = sync_parts(flat, landing, keys, strict)
    return kept.unionByName(replaced)


def change_counts(keys: DataFrame) -> DataFrame:
    """One row: how many keys a sync inserts, updates and changes in all."""
    return keys.agg(
        F.count_if("is_new").alias("inserted"),
        F.count_if(~F.col("is_new")).alias("updated"),
        F.count(F.lit(1)).alias("changed"),
    )
