"""Date parsing and event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in order when a business date arrives as text.
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date_multi(c, formats=DEFAULT_DATE_FORMATS) -> Column:
    """First format that parses wins; impossible or unknown text gives NULL (never an error)."""
    s = F.trim(_c(c))
    return F.coalesce(*[F.try_to_date(s, fmt) for fmt in formats])


def date_key(c) -> Column:
    """yyyymmdd as int, the usual key of a date dimension."""
    d = _c(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def to_event_time(c, tz: str) -> Column:
    """timestamp_ntz -> timestamp whose UTC wall clock equals the ntz value.

    Watermarks need a zoned timestamp; shifting by the session zone keeps
    window boundaries on the calendar days of the source data whatever the
    session time zone is.
    """
    return F.from_utc_timestamp(_c(c).cast("timestamp"), tz)


def from_event_time(c, tz: str) -> Column:
    """Inverse of :func:`to_event_time`: back to timestamp_ntz."""
    return F.to_utc_timestamp(_c(c), tz).cast("timestamp_ntz")
