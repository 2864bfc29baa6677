"""The daily summary: last event per vehicle for one event day, and its upsert and backfill."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegralType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from fleetlake.functions import times
from fleetlake.operators import event_days, latest, quality, sinks
from fleetlake.registry import (
    LATENESS_HOURS,
    LOOKBACK_DAYS,
    STORED_SUMMARY,
    SUMMARY_REQUIRED,
    TIE,
    VEHICLE_EVENTS,
    Lake,
    changes_of,
)
from fleetlake.sources.tables import in_partitions, is_streamed, open_table, scan_partitions


class BadInput(ValueError):
    """Events in the summary window break the schema; nothing was written."""


@dataclass(frozen=True)
class SummaryResult:
    """How a job went.  Without events ``reason`` says why, and ``sample`` shows the earliest of those
    that arrived but lie outside the window.  ``kept_days`` are days that a backfill did not replace."""

    status: str
    rows: int
    first_day: date
    last_day: date
    reason: str | None = None
    sample: tuple[Row, ...] = ()
    kept_days: tuple[str, ...] = ()


# --- what to compute ------------------------------------------------------------------------


def target(text: str | None = None, as_of: datetime | None = None) -> date:
    """A ``YYYY-MM-DD`` parameter, or the UTC date of the run."""
    if text is not None:
        return datetime.strptime(text, "%Y-%m-%d").date()
    return times.as_utc(as_of or times.utc_now()).date()


def arrival_partitions(day: date, lookback_days: int) -> list[date]:
    """Where the events of a day may have arrived: its own partition and those after it."""
    return [day + timedelta(days=n) for n in range(lookback_days)]


def window_events(
    events: DataFrame,
    target_date: date,
    as_of: datetime | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    lateness_hours: int | None = LATENESS_HOURS,
) -> DataFrame:
    """Events of the day before ``target_date`` that arrived within ``lookback_days`` partitions
    and are at most ``lateness_hours`` old at ``as_of``."""
    day = times.days_before(target_date, 1)
    cutoff = None
    if lateness_hours is not None:
        cutoff = times.as_utc(as_of or times.utc_now()) - timedelta(hours=lateness_hours)
    arrived = in_partitions(events, arrival_partitions(day, lookback_days))
    return latest.late_window(arrived, day, day, cutoff)


def backfill_events(
    events: DataFrame, first_day: date, last_day: date, lookback_days: int | None = None
) -> DataFrame:
    """Events of a range of days, however late they arrived.

    With ``lookback_days`` each event must have arrived within that many partitions of its own
    day, as in the daily job.
    """
    arrived = events.where(F.col("date") >= F.lit(first_day))
    if lookback_days is not None:
        arrived = arrived.where(F.col("date") < F.lit(last_day + timedelta(days=lookback_days)))
    window = latest.late_window(arrived, first_day, last_day)
    if lookback_days is not None:
        own_day = times.event_date(window, "event_time")
        window = window.where(
            (F.col("date") >= own_day) & (F.col("date") < F.date_add(own_day, lookback_days))
        )
    return window


def summarize(events: DataFrame, tie_break: Sequence[str] = latest.TIE_BREAK) -> DataFrame:
    """Summary rows for every (vehicle, day) among ``events``, read in one pass and one shuffle."""
    needed = dict.fromkeys(["vehicle_id", "event_time", "event_type", *tie_break])
    last = latest.last_per_vehicle_day(
        latest.with_event_date(events.select(*needed)), tie_break=tie_break
    )
    return last.select(
        "vehicle_id",
        F.col("event_time").alias("last_event_time"),
        F.col("event_type").alias("last_event_type"),
        F.col("day").cast("string").alias("day"),
    )


def daily_summary(
    events: DataFrame,
    target_date: date,
    as_of: datetime | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    lateness_hours: int | None = LATENESS_HOURS,
    tie_break: Sequence[str] = latest.TIE_BREAK,
) -> DataFrame:
    """The summary of the day before ``target_date``."""
    return summarize(window_events(events, target_date, as_of, lookback_days, lateness_hours), tie_break)


def backfill(
    events: DataFrame,
    first_day: date,
    last_day: date,
    lookback_days: int | None = None,
    tie_break: Sequence[str] = latest.TIE_BREAK,
) -> DataFrame:
    """Summaries of all days of a range at once."""
    return summarize(backfill_events(events, first_day, last_day, lookback_days), tie_break)


def candidates(events: DataFrame, tie_break: Sequence[str] = latest.TIE_BREAK) -> DataFrame:
    """Events in the shape of stored summary rows, each a candidate for its (vehicle, day)."""
    return events.select(
        "vehicle_id",
        F.col("event_time").alias("last_event_time"),
        F.col("event_type").alias("last_event_type"),
        times.event_day(events, "event_time").alias("day"),
        tie_values(events, tie_break).alias(TIE),
    )


def tie_values(events: DataFrame, tie_break: Sequence[str]) -> Column:
    """What is stored of the tie-break columns: texts that rank as the columns do, nulls last."""
    return F.array(*[_sortable(events, c) for c in tie_break]).cast("array<string>")


def _sortable(events: DataFrame, column: str) -> Column:
    """The value as text that sorts as the value does."""
    kind, value = events.schema[column].dataType, F.col(column)
    if isinstance(kind, DateType):
        kind, value = LongType(), F.unix_date(value)
    elif isinstance(kind, TimestampType):
        kind, value = LongType(), F.unix_micros(value)
    elif isinstance(kind, BooleanType):
        kind, value = LongType(), value.cast("long")
    if isinstance(kind, IntegralType):
        kind, value = DecimalType(19, 0), value.cast(DecimalType(19, 0))
    if isinstance(kind, DecimalType) and kind.precision <= 36:
        # Moved up until no value is negative, then all of one width.
        offset = F.lit(Decimal(10) ** (kind.precision - kind.scale)).cast(DecimalType(kind.precision + 1, kind.scale))
        return F.lpad((value + offset).cast("string"), kind.precision + 3, "0")
    if isinstance(kind, (StringType, TimestampNTZType)):
        return value.cast("string")
    raise TypeError(f"{column} is {kind.simpleString()}, which cannot be stored as a tie-break")


def merge_latest(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Stored rows and new ones or candidates together, the latest per (vehicle, day), ranked once."""
    every = stored.unionByName(arrived, allowMissingColumns=True)
    ties = (TIE, "last_event_type") if TIE in every.columns else ("last_event_type",)
    return latest.last_per_vehicle_day(every, order_by="last_event_time", tie_break=ties)


# --- jobs that write ------------------------------------------------------------------------


def events_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return open_table(spark, lake.raw(VEHICLE_EVENTS.name), VEHICLE_EVENTS.table, "date")


def events_arrived(spark: SparkSession, lake: Lake, days: Sequence[date]) -> DataFrame:
    texts = [d.isoformat() for d in days]
    return scan_partitions(spark, lake.raw(VEHICLE_EVENTS.name), VEHICLE_EVENTS.table, texts)


def stored_summary(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """The stored summary as it stands, ``days`` of it or all: on days with changes the latest row of each vehicle.

    Days without changes are read as they are.  Which days have changes is seen from folder names, so both
    halves read their own partitions only.
    """
    base = open_table(spark, path, STORED_SUMMARY, "day")
    changes = open_table(spark, changes_of(path), STORED_SUMMARY, "day")
    changed = sinks.partitions(spark, changes_of(path), "day")
    if days is not None:
        base, changes = (t.where(F.col("day").isin(list(days))) for t in (base, changes))
        changed = sorted({*changed} & {*days})
    if not changed:
        return base
    open_ = F.col("day").isin(changed)
    return base.where(~open_).unionByName(merge_latest(base.where(open_), changes.where(open_)))


def upsert(spark: SparkSession, arrived: DataFrame, path: str) -> int:
    """Adds summary rows of any days to the changes of the stored summary; returns how many.

    Readers take the latest row per vehicle and day, so an older one changes nothing, and neither does adding
    the same rows again.  ``compact_summary`` folds the changes in.
    """
    return sinks.append_changes(arrived.select(*(c for c in STORED_SUMMARY.names if c in arrived.columns)), path)


def compact_summary(spark: SparkSession, path: str, before: date | None = None) -> list[str]:
    """Folds the changes of days before ``before``, or of all days, into the stored summary; returns the days.

    The folded rows are stored before the old files go, changes last.  Until then the day counts as changed
    and is read by rank, so that after a crash nothing is missing or seen twice.  Changes that arrive
    meanwhile stay changes.
    """
    changes = changes_of(path)
    days = [d for d in sinks.partitions(spark, changes, "day") if before is None or d < before.isoformat()]
    if days:
        old = [f for d in days for place in (path, changes) for f in sinks.partition_files(spark, place, "day", d)]
        folded = sinks.stage(stored_summary(spark, path, days), "summary-folded")
        sinks.append_partitioned(folded, path, "day")
        sinks.delete_files(spark, old)
    return days


def _checked(window: DataFrame, tie_break: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The window with row and null counts riding along on whatever pass reads it."""
    quality.require_columns(window, SUMMARY_REQUIRED)
    seen = Observation()
    columns = dict.fromkeys([*SUMMARY_REQUIRED, *tie_break])
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in SUMMARY_REQUIRED]
    return window.select(*columns).observe(seen, F.count(F.lit(1)).alias("events"), *nulls), seen


def _raise_on_nulls(counts: dict[str, int]) -> None:
    bad = {c: counts[c] for c in SUMMARY_REQUIRED if counts[c]}
    if bad:
        raise BadInput(f"required fields hold nulls: {bad}")


def _nothing(arrived: DataFrame, first_day: date, last_day: date) -> SummaryResult:
    """No events in the window: nothing was there, or what was there lies outside it."""
    sample = tuple(latest.event_time_sample(arrived.select("vehicle_id", "event_time", "date"), then=("vehicle_id",)).collect())
    if sample:
        reason = "outside_window"
    else:
        reason = "empty_partitions" if arrived.inputFiles() else "no_partitions"
    return SummaryResult("no_events", 0, first_day, last_day, reason, sample)


def run_daily_summary(
    spark: SparkSession,
    lake: Lake,
    target_date: date | None = None,
    as_of: datetime | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    lateness_hours: int | None = LATENESS_HOURS,
    tie_break: Sequence[str] = latest.TIE_BREAK,
) -> SummaryResult:
    """Computes one day and merges it into the stored summary, reading the events once.

    Validation counts are taken on the same pass, before anything is published.
    """
    target_date = target_date or target(as_of=as_of)
    day = times.days_before(target_date, 1)
    events = events_arrived(spark, lake, arrival_partitions(day, lookback_days))
    window, seen = _checked(
        window_events(events, target_date, as_of, lookback_days, lateness_hours), tie_break
    )
    stored = stored_summary(spark, lake.summary, [day.isoformat()])
    merged = sinks.stage(merge_latest(stored, candidates(window, tie_break)), "summary-day")
    counts = seen.get
    _raise_on_nulls(counts)
    if not counts["events"]:
        return _nothing(events, day, day)
    return SummaryResult("success", sinks.overwrite_days(merged, lake.summary), day, day)


def run_backfill(
    spark: SparkSession,
    lake: Lake,
    first_day: date,
    last_day: date,
    lookback_days: int | None = None,
    tie_break: Sequence[str] = latest.TIE_BREAK,
    replace_all: bool = False,
) -> SummaryResult:
    """Recomputes a range of days from the raw events in one job and replaces them.

    A day whose own arrival partition is there is replaced, and left without rows if it has no events.  Of
    any other day the raw events may be gone, so what is stored is kept and only added to; the result names
    these days in ``kept_days``.  ``replace_all`` replaces them as well.
    """
    events = _events_of_days(spark, lake, first_day, last_day, lookback_days)
    window, seen = _checked(backfill_events(events, first_day, last_day, lookback_days), tie_break)
    rebuilt = merge_latest(spark.createDataFrame([], STORED_SUMMARY), candidates(window, tie_break))
    rebuilt = sinks.stage(rebuilt, "summary-backfill")
    counts = seen.get
    _raise_on_nulls(counts)
    days = [(first_day + timedelta(days=n)).isoformat() for n in range((last_day - first_day).days + 1)]
    there = set(days) if replace_all else _arrived(spark, events, lake, days)
    with_rows = {row.day for row in rebuilt.select("day").distinct().collect()}  # days of the range at most
    replaced, kept = [d for d in days if d in there], [d for d in days if d not in there]
    rows = 0
    if counts["events"]:
        rows = sinks.overwrite_days(rebuilt.where(F.col("day").isin(replaced)), lake.summary) if with_rows & there else 0
        rows += upsert(spark, rebuilt.where(F.col("day").isin(kept)), lake.summary) if with_rows - there else 0
    sinks.drop_partitions(spark, lake.summary_changes, "day", replaced)
    sinks.drop_partitions(spark, lake.summary, "day", [d for d in replaced if d not in with_rows])
    if not counts["events"]:
        return replace(_nothing(events, first_day, last_day), kept_days=tuple(kept))
    return SummaryResult("success", rows, first_day, last_day, kept_days=tuple(kept))


def _events_of_days(spark: SparkSession, lake: Lake, first_day: date, last_day: date, lookback_days: int | None) -> DataFrame:
    """The arrival partitions that can hold events of the range; other partitions are not even listed."""
    arrived = event_days.partitions_with(spark, lake, VEHICLE_EVENTS, first_day, last_day)
    if arrived is None:
        return events_table(spark, lake)
    until = None if lookback_days is None else (last_day + timedelta(days=lookback_days)).isoformat()
    wanted = [date.fromisoformat(d) for d in arrived if d >= first_day.isoformat() and (until is None or d < until)]
    return events_arrived(spark, lake, wanted) if wanted else spark.createDataFrame([], VEHICLE_EVENTS.table)


def _arrived(spark: SparkSession, events: DataFrame, lake: Lake, days: Sequence[str]) -> set[str]:
    """Those of the days whose arrival partitions hold files; a streamed table is asked for its rows."""
    path = lake.raw(VEHICLE_EVENTS.name)
    if is_streamed(spark, path):
        found = events.where(F.col("date").between(F.lit(days[0]).cast("date"), F.lit(days[-1]).cast("date")))
        return {row[0].isoformat() for row in found.select("date").distinct().collect()}
    return {d for d in days if sinks.has_files(spark, path, "date", d)}


def revise_summary(
    spark: SparkSession,
    lake: Lake,
    arrival_days: Sequence[date],
    tie_break: Sequence[str] = latest.TIE_BREAK,
) -> int:
    """Folds everything that arrived on the given days into the summaries of whatever event days
    it belongs to, so that late events update earlier days; returns the rows that may change something."""
    arrived = candidates(events_arrived(spark, lake, arrival_days), tie_break)
    arrived = merge_latest(spark.createDataFrame([], STORED_SUMMARY), arrived)
    return upsert(spark, arrived, lake.summary)
