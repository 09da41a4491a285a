"""Offset pages and refresh-filtered extracts over any table of records."""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import instant, refresh_instant
from tidemark.schema import PAGE_CAP
from tidemark.session import written

def page_size(top: int, cap: int = PAGE_CAP) -> int:
    """``top``, refused beyond the cap: a page that is shorter than asked for would look like the last one."""
    if not 0 < top <= cap:
        raise ValueError(f"a page holds 1 to {cap} records, not {top}")
    return top


def file_place(name: Column) -> Column:
    """Where the rows of a file lie in a sorted write: number of the task, number of its file."""
    file_no = F.regexp_extract(name, r"part-(\d+)", 1).cast("long")
    piece = F.regexp_extract(name, r"-c(\d+)\.", 1).cast("long")
    return F.struct(file_no.alias("no"), piece.alias("piece"))


def numbered(df: DataFrame, by: list[str]) -> DataFrame:
    """Every row with its ``position`` (from 0) in the order of ``by``, which must be total.

    One range-partitioned sort is written out; the position is the row's place in its file plus
    the rows of the files before it. Nothing but the row count per file meets in one task.
    """
    rows = written(df.orderBy(*by), "numbered")
    placed = rows.select("*", file_place(F.col("_metadata.file_name")).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # One short row per file just written, so sending them to every task is cheap.
    starts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    position = (F.col("_start") + F.col("_row")).alias("position")
    return placed.join(F.broadcast(starts), "_file").select(*df.columns, position)


def page(df: DataFrame, skip: int, top: int, by: list[str], cap: int = PAGE_CAP) -> DataFrame:
    """Rows ``skip .. skip+top`` in the order of ``by``, which must be a total order, with their ``position``.

    However deep the page lies, only its own rows are sorted a second time. Only ``by`` is sorted and written; the page's
    other columns are looked up by it, and its rows are at most ``cap``.
    """
    position = F.col("position")
    inside = (position >= skip) & (position < skip + page_size(top, cap))
    found = numbered(df.select(*by), by).where(inside)
    if set(df.columns) - set(by):
        keys = F.broadcast(found.select("position", *(F.col(c).alias(f"_by_{c}") for c in by)))
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by))
        found = df.join(keys, same)
    return found.select(*df.columns, "position").orderBy("position")


def pages(df: DataFrame, top: int, by: list[str], cap: int = PAGE_CAP) -> DataFrame:
    """Every row with its ``page_seq`` and ``pos``: all the pages a reader gets until a short one."""
    size = page_size(top, cap)
    position = F.col("position")
    page_seq = F.expr(f"position div {size}").alias("page_seq")
    return numbered(df, by).select(*df.columns, page_seq, (position % size).cast("int").alias("pos"))


def incremental(records: DataFrame, mark: datetime | None, strict: bool = True) -> DataFrame:
    """Records refreshed at or after the mark, re-ordered by refresh; everything if there is no mark.

    The boundary is inclusive: boundary rows are read again and the upsert absorbs them.
    """
    if mark is None:
        return records
    refresh = refresh_instant(F.col("rec"), strict)
    return records.where(refresh >= instant(mark)).select("rec", F.struct(refresh.alias("refresh"), "ord").alias("ord"))
