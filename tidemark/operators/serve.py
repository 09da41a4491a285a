"""Reports over the published tables: slices, ranges, containment, lookups, top-k, rollups."""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions import contains, instant
from tidemark.schema import FIELD_MAP


def _literal(value) -> Column:
    return instant(value) if isinstance(value, datetime) else F.lit(value)


def between(column: str, low=None, high=None) -> Column:
    """Inclusive range; an end given as None is open."""
    ends = []
    if low is not None:
        ends.append(F.col(column) >= _literal(low))
    if high is not None:
        ends.append(F.col(column) <= _literal(high))
    return reduce(lambda a, b: a & b, ends, F.lit(True))


def slice_by(df: DataFrame, **conditions) -> DataFrame:
    """Rows that meet every condition: ``column=value`` or ``column=(low, high)``.

    All conditions are plain comparisons, so they reach the Parquet scan and prune row groups.
    """
    for column, wanted in conditions.items():
        df = df.where(between(column, *wanted) if isinstance(wanted, tuple) else F.col(column) == _literal(wanted))
    return df


def containing(df: DataFrame, pattern) -> DataFrame:
    """Rows whose ``raw`` contains the pattern.

    On the flat table a non-empty text member of the pattern implies the value of its column;
    adding that comparison lets the scan skip row groups before any record is opened.
    """
    if isinstance(pattern, dict):
        for field in FIELD_MAP:
            wanted = pattern.get(field.source)
            is_text = isinstance(field.type, T.StringType) and isinstance(wanted, str) and wanted != ""
            if is_text and field.column in df.columns:
                df = df.where(F.col(field.column) == F.lit(wanted))
    return df.where(contains(F.col("raw"), pattern))


def top_by(df: DataFrame, column: str, k: int, largest: bool = True) -> DataFrame:
    """The k rows with the largest (or smallest) value, ties by hash: a top-k, never a full sort."""
    order = F.desc_nulls_last(column) if largest else F.asc_nulls_last(column)
    return df.orderBy(order, "hash").limit(k)


def lookup(flat: DataFrame, other: DataFrame, key: str, other_key: str, how: str = "inner") -> DataFrame:
    """Join the flat table to another on one of its ids.

    Spark broadcasts ``other`` if it is below the session's threshold; beyond it, adaptive
    execution splits the partitions of hot ids.
    """
    return flat.join(other, flat[key] == other[other_key], how)


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("projects"),
        F.sum("totalobligated").alias("total_obligated"),
        F.sum("federalshare").alias("federal_share"),
    ]


def rollup_state_incident(flat: DataFrame) -> DataFrame:
    return flat.groupBy("stateabbr", "incidenttype").agg(*_measures())


def rollup_month_state(flat: DataFrame) -> DataFrame:
    month = F.trunc("declarationdate", "MM").alias("month")
    return flat.groupBy(month, "stateabbr").agg(*_measures())


def rollup_status(flat: DataFrame) -> DataFrame:
    return flat.groupBy("projectstatus", "projectprocessstep").agg(
        F.count(F.lit(1)).alias("projects"), F.sum("projectamount").alias("project_amount")
    )


def top_disasters(flat: DataFrame, k: int) -> DataFrame:
    """Disasters with the largest obligated amount, ties by number."""
    totals = flat.groupBy("disasternumber").agg(*_measures())
    return totals.orderBy(F.desc_nulls_last("total_obligated"), "disasternumber").limit(k)
