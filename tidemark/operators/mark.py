"""The high-water mark of a landing table and the mark the next cycle starts from."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import instant, later_of, start_of_day

RESUME = "resume"  # continue exactly where landing stands
TODAY_GUARD = "today_guard"  # the same, but never before today's midnight


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def high_water_mark(landing: DataFrame) -> DataFrame:
    """One row with the latest refresh; NULL over no rows or only unknown refreshes."""
    return landing.agg(F.max("lastrefresh").alias("mark"))


def next_mark(landing: DataFrame, as_of: datetime, policy: str = RESUME) -> DataFrame:
    """One row with the instant the next extract starts from.

    With no mark yet, both policies give the midnight that began the day of ``as_of``.
    """
    midnight = start_of_day(instant(as_of))
    if policy == RESUME:
        mark = F.coalesce("mark", midnight)
    elif policy == TODAY_GUARD:
        mark = later_of(F.col("mark"), midnight)
    else:
        raise ValueError(f"unknown mark policy: {policy}")
    return high_water_mark(landing).select(mark.alias("mark"))


def mark_after(latest: datetime | None, as_of: datetime, policy: str = RESUME) -> datetime:
    """``next_mark`` for a latest refresh that is already known."""
    zoned = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    midnight = zoned.astimezone(timezone.utc).replace(hour=0, minute=0, second=0, microsecond=0)
    if policy not in (RESUME, TODAY_GUARD):
        raise ValueError(f"unknown mark policy: {policy}")
    if latest is None:
        return midnight
    return latest if policy == RESUME else max(latest, midnight)
