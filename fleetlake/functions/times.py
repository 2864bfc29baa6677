"""Time arithmetic in UTC, whatever the session time zone.

Stored times are instants (``TIMESTAMP``).  Their UTC reading (``TIMESTAMP_NTZ``) is reached
through microseconds since the epoch.  Going through the session's local time instead would lose
an hour wherever clocks are set back.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# A full date must lead; text that ends with its time of day names no zone.
ISO_DATE = r"^\s*\d{4}-\d{2}-\d{2}"
ISO_WITHOUT_ZONE = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?)?\s*$"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def as_utc(moment: datetime) -> datetime:
    """An aware UTC datetime; a naive one is taken to be UTC already."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def day_start(day: date) -> datetime:
    return datetime(day.year, day.month, day.day, tzinfo=timezone.utc)


def days_before(day: date, n: int) -> date:
    return day - timedelta(days=n)


def instant_to_utc(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def utc_to_instant(wall: Column) -> Column:
    """The reverse.  By way of text, because differences of timestamps use the session's zone."""
    return F.concat(wall.cast("string"), F.lit("Z")).cast("timestamp_ltz")


def utc_today() -> Column:
    return instant_to_utc(F.current_timestamp()).cast("date")


def utc_reading(df: DataFrame, column: str) -> Column:
    """The zone-free UTC value of a time column of either timestamp type."""
    kind = df.schema[column].dataType
    if isinstance(kind, TimestampNTZType):
        return F.col(column)
    if isinstance(kind, TimestampType):
        return instant_to_utc(F.col(column))
    raise TypeError(f"{column} is {kind.simpleString()}, expected a timestamp")


def time_literal(moment: datetime, kind: DataType) -> Column:
    """A literal of the column's own type, so that comparisons reach the Parquet scan."""
    text = as_utc(moment).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(kind, TimestampNTZType):
        return F.expr(f"timestamp_ntz'{text}'")
    return F.expr(f"timestamp_ltz'{text}Z'")


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to an instant, null if unreadable.  Text without a zone is UTC."""
    zoneless = utc_to_instant(text.try_cast("timestamp_ntz"))
    zoned = text.try_cast("timestamp_ltz")
    return F.when(text.rlike(ISO_WITHOUT_ZONE), zoneless).when(text.rlike(ISO_DATE), zoned)


def event_date(df: DataFrame, column: str) -> Column:
    """The UTC day of a time column."""
    return utc_reading(df, column).cast("date")


def event_day(df: DataFrame, column: str) -> Column:
    """The same as ``yyyy-MM-dd`` text."""
    return event_date(df, column).cast("string")
