"""The stored summary as base and changes: merged on read, folded in, typed ties, backfills that keep."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import quality, sinks
from fleetlake.plans import summary
from fleetlake.registry import VEHICLE_EVENTS
from fleetlake.sources import tables
from fleetlake.streaming import summary as stream_out
from fleetlake.streaming.ingest import tagged_stream
from tests.conftest import event
from tests.test_summary import AS_OF, EXAMPLE, TARGET, events, store, stored


def at(hour, kind="k", vehicle="V1", day="2025-11-08"):
    return (vehicle, f"{day}T{hour:02}:00:00Z", kind, day)


def add(spark, lake, *rows):
    return summary.upsert(spark, summary.candidates(events(spark, rows), ("event_type",)), lake.summary)


def kinds(spark, lake):
    return {k: v[1] for k, v in stored(spark, lake).items()}


def test_changes_are_as_many_as_what_changed(spark, lake):
    sinks.overwrite_days(summary.summarize(events(spark, [at(1, "a", f"V{n}") for n in range(500)])), lake.summary)
    before = sinks.partition_files(spark, lake.summary, "day", "2025-11-08")
    assert add(spark, lake, at(2, "b", "V7"), at(0, "z", "V8")) == 2
    assert sinks.partition_files(spark, lake.summary, "day", "2025-11-08") == before
    assert spark.read.parquet(lake.summary_changes).count() == 2
    found = kinds(spark, lake)
    assert (len(found), found["V7", "2025-11-08"], found["V8", "2025-11-08"]) == (500, "b", "a")


def test_days_without_changes_are_not_ranked(spark, lake):
    days = ("2025-11-07", "2025-11-08")
    sinks.overwrite_days(summary.summarize(events(spark, [at(1, day=d) for d in days])), lake.summary)
    assert "Window" not in summary.stored_summary(spark, lake.summary)._jdf.queryExecution().toString()
    add(spark, lake, at(2, "b"))
    plan = summary.stored_summary(spark, lake.summary, ["2025-11-07"])._jdf.queryExecution().toString()
    assert "Window" not in plan
    assert "Window" in summary.stored_summary(spark, lake.summary)._jdf.queryExecution().toString()


def test_folding_changes_nothing(spark, lake):
    add(spark, lake, at(1, "a"), at(1, "x", "V2", "2025-11-09"))
    add(spark, lake, at(3, "c"), at(2, "b"))
    before = stored(spark, lake)
    assert summary.compact_summary(spark, lake.summary, before=date(2025, 11, 9)) == ["2025-11-08"]
    assert sinks.partitions(spark, lake.summary_changes, "day") == ["2025-11-09"]
    assert stored(spark, lake) == before
    add(spark, lake, at(4, "d"))
    summary.compact_summary(spark, lake.summary)
    assert sinks.partitions(spark, lake.summary_changes, "day") == []
    assert kinds(spark, lake) == {("V1", "2025-11-08"): "d", ("V2", "2025-11-09"): "x"}
    assert summary.compact_summary(spark, lake.summary) == []


@pytest.mark.parametrize("step", ["append_partitioned", "delete_files"])
def test_a_crash_while_folding_is_not_seen(spark, lake, monkeypatch, step):
    sinks.overwrite_days(summary.summarize(events(spark, [at(1, "a"), at(1, "a", "V2")])), lake.summary)
    add(spark, lake, at(3, "c"))
    before = stored(spark, lake)
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(sinks, step, lambda *a: (_ for _ in ()).throw(RuntimeError))
        summary.compact_summary(spark, lake.summary)
    assert stored(spark, lake) == before
    tables.create_views(spark, lake, ("crash_raw", "crash_reports"))
    assert spark.table("crash_reports.daily_summary").count() == 2
    summary.compact_summary(spark, lake.summary)
    assert stored(spark, lake) == before and spark.read.parquet(lake.summary).where("day = '2025-11-08'").count() == 2


def test_changes_that_arrive_while_folding_stay(spark, lake, monkeypatch):
    add(spark, lake, at(1, "a"))
    append = sinks.append_partitioned

    def late(df, path, *more):
        if not path.endswith("_changes"):
            append(df, path, *more)
            return add(spark, lake, at(9, "late"))
        return append(df, path, *more)

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "append_partitioned", late)
        summary.compact_summary(spark, lake.summary)
    assert kinds(spark, lake) == {("V1", "2025-11-08"): "late"}


def test_views_show_changes(spark, lake):
    databases = ("changes_raw", "changes_reports")
    tables.create_views(spark, lake, databases)
    view = f"{databases[1]}.daily_summary"
    assert spark.table(view).count() == 0
    sinks.overwrite_days(summary.summarize(events(spark, [at(1, "a"), at(1, "a", "V2", "2025-11-07")])), lake.summary)
    tables.create_views(spark, lake, databases)
    add(spark, lake, at(3, "c"))
    shown = {(r.vehicle_id, r.day): r.last_event_type for r in spark.table(view).collect()}
    assert shown == kinds(spark, lake) == {("V1", "2025-11-08"): "c", ("V2", "2025-11-07"): "a"}
    assert spark.sql(f"SELECT * FROM {view} WHERE day = '2025-11-08'").count() == 1
    summary.compact_summary(spark, lake.summary)
    assert {(r.vehicle_id, r.day): r.last_event_type for r in spark.table(view).collect()} == shown


VALUES = {
    "long": [-(2**63), -5, -2, 0, 3, 10, 2**63 - 1],
    "int": [-(2**31), -10, -9, 0, 7],
    "decimal(10,3)": [Decimal("-12.5"), Decimal("-12.499"), Decimal("0"), Decimal("0.001"), Decimal("9999999.999")],
    "date": [date(1, 1, 1), date(1969, 12, 31), date(1970, 1, 1), date(2025, 11, 8)],
    "timestamp": [datetime(1960, 1, 1), datetime(1970, 1, 1), datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 0, 0, 5)],
    "timestamp_ntz": [datetime(1960, 1, 1), datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 0, 0, 5)],
    "string": ["", "A", "a", "ab", "ä"],
    "boolean": [False, True],
}


@pytest.mark.parametrize("kind", list(VALUES))
def test_stored_ties_sort_as_their_values(spark, kind):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(VALUES[kind])] + [(-1, None)], f"n int, v {kind}")
    ordered = [r.n for r in df.repartition(3).withColumn("t", summary.tie_values(df, ["v"])).orderBy("t").collect()]
    assert ordered == list(range(-1, len(VALUES[kind])))


def test_ties_that_cannot_be_stored_are_refused(spark):
    with pytest.raises(TypeError):
        summary.tie_values(spark.createDataFrame([(1.5,)], "v double"), ["v"])


def test_negative_numbers_settle_ties_in_job_and_query_alike(spark, lake):
    rows = events(spark, [at(1, "old"), at(1, "new")]).withColumn("n", F.when(F.col("event_type") == "new", -2).otherwise(-5))
    asked = summary.summarize(rows, ("n",)).first().last_event_type
    for kind in ("old", "new"):
        summary.upsert(spark, summary.candidates(rows.where(F.col("event_type") == kind), ("n",)), lake.summary)
    assert asked == "new" and kinds(spark, lake) == {("V1", "2025-11-08"): "new"}


def test_a_stream_keeps_to_the_tie_break(spark, lake, incoming):
    """The greater source wins, whichever micro-batch brings it, though its type is the lesser."""
    for n, (kind, source) in enumerate([("zzz", "device"), ("aaa", "sensor"), ("mmm", "mobile")]):
        incoming.events(f"2025110812000{n}", event(kind=kind, source=source))
        tagged = tagged_stream(spark, str(incoming), VEHICLE_EVENTS)
        changes = stream_out.last_per_vehicle_day_stream(quality.good(tagged, VEHICLE_EVENTS), tie_break=("event_source",))
        stream_out.summary_stream(changes, lake.summary, f"{lake.base}/checkpoint").awaitTermination()
    assert kinds(spark, lake) == {("V1", "2025-11-08"): "aaa"}


def test_a_backfill_without_raw_events_removes_nothing(spark, lake):
    store(spark, lake, EXAMPLE)
    summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    before = stored(spark, lake)
    elsewhere = type(lake)(f"{lake.base}/wrong", reports=lake.base)
    result = summary.run_backfill(spark, elsewhere, date(2025, 11, 7), date(2025, 11, 8))
    assert (result.status, result.reason, result.kept_days) == ("no_events", "no_partitions", ("2025-11-07", "2025-11-08"))
    assert before and stored(spark, lake) == before


def test_a_backfill_adds_to_days_whose_raw_events_went(spark, lake):
    """Retention took the day's own partition; a late event is still there."""
    add(spark, lake, at(9, "kept"), at(1, "older", "V2"))
    store(spark, lake, [("V2", "2025-11-08T12:00:00Z", "late", "2025-11-10"), ("V3", "2025-11-10T01:00:00Z", "own", "2025-11-10")])
    sinks.overwrite_days(summary.summarize(events(spark, [at(1, "stale", "V9", "2025-11-10")])), lake.summary)
    result = summary.run_backfill(spark, lake, date(2025, 11, 8), date(2025, 11, 10))
    assert result.kept_days == ("2025-11-08", "2025-11-09")
    assert kinds(spark, lake) == {("V1", "2025-11-08"): "kept", ("V2", "2025-11-08"): "late", ("V3", "2025-11-10"): "own"}


def test_a_backfill_takes_changes_of_its_days_with_it(spark, lake):
    store(spark, lake, EXAMPLE)
    add(spark, lake, at(23, "wrong", "V1"), at(1, "other", "V1", "2025-11-20"))
    summary.run_backfill(spark, lake, date(2025, 11, 8), date(2025, 11, 8))
    found = kinds(spark, lake)
    assert found["V1", "2025-11-08"] == "end" and found["V1", "2025-11-20"] == "other"
