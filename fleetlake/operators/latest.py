"""The last event per vehicle and event day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions import times

TIE_BREAK = ("event_type", "event_source")


def with_event_day(events: DataFrame, column: str = "event_time") -> DataFrame:
    return events.withColumn("day", times.event_day(events, column))


def with_event_date(events: DataFrame, column: str = "event_time") -> DataFrame:
    """``day`` as a date: four bytes to sort and shuffle by where text takes more."""
    return events.withColumn("day", times.event_date(events, column))


def late_window(
    events: DataFrame,
    first_day: date,
    last_day: date,
    cutoff: datetime | None = None,
    column: str = "event_time",
) -> DataFrame:
    """Events of the UTC days ``first_day``..``last_day``, none older than ``cutoff``.

    Day start and cutoff merge into one lower bound; both bounds are plain literals that reach the
    Parquet scan.
    """
    kind = events.schema[column].dataType
    lower = times.day_start(first_day)
    if cutoff is not None:
        lower = max(lower, times.as_utc(cutoff))
    upper = times.day_start(last_day) + timedelta(days=1)
    return events.where(
        (F.col(column) >= times.time_literal(lower, kind)) & (F.col(column) < times.time_literal(upper, kind))
    )


def last_per_vehicle_day(
    events: DataFrame, order_by: str = "event_time", tie_break: Sequence[str] = TIE_BREAK
) -> DataFrame:
    """Keeps one row per (``vehicle_id``, ``day``): the latest, ties settled by ``tie_break``.

    The rank filter sits directly on the window, so Spark keeps one row per key in every map task
    before the shuffle.  A vehicle with a third of all events ships as few rows as any other.
    """
    newest_first = [F.col(c).desc() for c in (order_by, *tie_break)]
    window = Window.partitionBy("vehicle_id", "day").orderBy(*newest_first)
    return events.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")


def event_time_sample(events: DataFrame, n: int = 5, column: str = "event_time", then: Sequence[str] = ()) -> DataFrame:
    """The ``n`` earliest events, for a look at what a table holds when a summary came out empty."""
    return events.orderBy(column, *then).limit(n)
