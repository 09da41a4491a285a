"""Row counts per range of a column, kept with each load: which range holds the rows of a page, without reading the table.

    <root>/counted/load=<id>/*.parquet     (bucket, at, n)

``at`` is the hour of the rows' refresh, NULL where it is unknown; ``n`` counts the rows of the load and takes away those that
it replaces in earlier ones, at the hours they had. A bucket counts what its loads in a commit say, all added up.
"""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import from_micros, instant

SCHEMA = "bucket int, at timestamp, n long"

#: Column by which a table's rows are counted, and the order of its pages; the last one tells rows of one refresh apart.
COUNTED = {"landing": "lastrefresh"}
PAGED_BY = ("lastrefresh", "hash")


def hour(column: str) -> Column:
    return F.date_trunc("hour", F.col(column))


def counts(rows: DataFrame, column: str, sign: int = 1) -> DataFrame:
    """``(bucket, at, n)`` of rows that have a bucket; one row per bucket and hour and task is all that is shuffled."""
    in_bucket = rows.where(F.col("bucket").isNotNull()).groupBy("bucket", hour(column).alias("at"))
    return in_bucket.agg((F.count(F.lit(1)) * sign).alias("n"))


@dataclass(frozen=True)
class Span:
    """Hours that hold the wanted positions, and the rows before them. Without a beginning it holds unknown refreshes too."""

    begin: datetime | None
    end: datetime | None
    before: int

    def holds(self, column: str) -> Column:
        """A plain comparison, so that it reaches the scan."""
        value = F.col(column)
        if self.end is None:
            return value.isNull()
        inside = value < F.lit(instant(self.end)) + F.expr("INTERVAL 1 HOUR")
        return inside & (value >= F.lit(instant(self.begin))) if self.begin is not None else value.isNull() | inside


def span(counted: DataFrame, skip: int, top: int) -> Span | None:
    """Where positions ``skip`` to ``skip + top`` lie in the order of ``at``, unknown ones first; None beyond the last row.

    One row per hour meets in one task, however many rows the table has.
    """
    hours = counted.groupBy("at").agg(F.sum("n").alias("n")).where("n > 0")
    until = F.sum("n").over(Window.orderBy(F.asc_nulls_first("at")).rowsBetween(Window.unboundedPreceding, 0))
    ends = hours.select(F.unix_micros("at").alias("at"), (until - F.col("n")).alias("since"), until.alias("until"))
    found = ends.where((F.col("until") > skip) & (F.col("since") < skip + top)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("at").isNull()).alias("unknown"), F.min("at").alias("begin"), F.max("at").alias("end"), F.min("since").alias("since")
    ).first()
    if not found.n:
        return None
    begin = None if found.unknown or found.begin is None else from_micros(found.begin)
    return Span(begin, None if found.end is None else from_micros(found.end), found.since)
