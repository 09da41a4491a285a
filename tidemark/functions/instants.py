"""Instants: start of day, ISO text, and the later of two."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(value: datetime) -> Column:
    """A literal instant; a datetime without a zone is UTC, whatever the driver's zone is."""
    return F.lit(value if value.tzinfo else value.replace(tzinfo=timezone.utc)).cast("timestamp")


def from_micros(micros: int | None) -> datetime | None:
    """A UTC datetime from microseconds since the epoch, exact to the microsecond."""
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)


def start_of_day(instant: Column) -> Column:
    """00:00 UTC of the instant's day (the session zone is pinned to UTC)."""
    return F.date_trunc("DAY", instant)


def iso_instant(instant: Column) -> Column:
    """ISO-8601 text with a Z suffix; microseconds are kept so that text and instant agree."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def quoted_iso(instant: Column) -> Column:
    """The same text in single quotes, as a source's filter expression takes an instant."""
    return F.concat(F.lit("'"), iso_instant(instant), F.lit("'"))


def later_of(*instants: Column) -> Column:
    """The latest of the given instants, ignoring NULLs. Compared as instants, never as text."""
    return F.greatest(*instants)
