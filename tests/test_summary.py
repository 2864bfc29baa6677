"""Daily summaries: the worked example, ties, lateness, upsert and backfill."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import times
from fleetlake.operators import latest, sinks
from fleetlake.plans import summary
from fleetlake.registry import SUMMARY, VEHICLE_EVENTS
from fleetlake.sources.tables import read_table

COLUMNS = "vehicle_id string, time string, event_type string, event_source string, date string"


def events(spark, rows):
    """Events from ``(vehicle, ISO time, type, arrival date)``."""
    df = spark.createDataFrame([(v, t, k, "sensor", d) for v, t, k, d in rows], COLUMNS)
    return df.select(
        "vehicle_id",
        times.parse_instant(F.col("time")).alias("event_time"),
        "event_source",
        "event_type",
        F.lit(None).cast("string").alias("event_value"),
        F.lit(None).cast("map<string,string>").alias("event_extra_data"),
        F.lit("test").alias("_source_file"),
        F.col("date").cast("date").alias("date"),
    )


def store(spark, lake, rows):
    sinks.append_partitioned(events(spark, rows), lake.raw("vehicle_events"))


def stored(spark, lake):
    df = summary.stored_summary(spark, lake.summary)
    return {
        (r.vehicle_id, r.day): (r.t, r.last_event_type)
        for r in df.withColumn("t", times.utc_reading(df, "last_event_time")).collect()
    }


EXAMPLE = [
    ("V1", "2025-11-08T10:00:00Z", "start", "2025-11-08"),
    ("V1", "2025-11-08T23:59:59.999999Z", "end", "2025-11-09"),
    ("V2", "2025-11-08T00:00:00Z", "park", "2025-11-08"),
    ("V1", "2025-11-07T12:00:00Z", "old", "2025-11-08"),
    ("V3", "2025-11-09T00:00:00Z", "next", "2025-11-09"),
    ("V4", "2025-11-08T12:00:00Z", "too late", "2025-11-10"),
]
TARGET = date(2025, 11, 9)
AS_OF = datetime(2025, 11, 9, 1)


def test_worked_example(spark, lake, zone):
    store(spark, lake, EXAMPLE)
    result = summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    assert (result.status, result.rows, result.first_day) == ("success", 2, date(2025, 11, 8))
    assert stored(spark, lake) == {
        ("V1", "2025-11-08"): (datetime(2025, 11, 8, 23, 59, 59, 999999), "end"),
        ("V2", "2025-11-08"): (datetime(2025, 11, 8), "park"),
    }


def test_default_target_keeps_the_first_hour(spark, lake):
    store(spark, lake, [("V1", "2025-11-08T00:30:00Z", "early", "2025-11-08")])
    assert summary.run_daily_summary(spark, lake, as_of=AS_OF).rows == 1


def test_cutoff(spark, lake, zone):
    rows = [
        ("V1", "2025-11-08T05:59:59Z", "before", "2025-11-08"),
        ("V2", "2025-11-08T06:00:00Z", "at", "2025-11-08"),
    ]
    found = summary.daily_summary(events(spark, rows), TARGET, datetime(2025, 11, 10, 6)).collect()
    assert [r.vehicle_id for r in found] == ["V2"]
    everything = summary.daily_summary(events(spark, rows), TARGET, lateness_hours=None)
    assert everything.count() == 2
    assert summary.daily_summary(events(spark, rows), TARGET).count() == 0  # long ago by now


def test_longer_lookback_takes_later_arrivals(spark):
    df = events(spark, EXAMPLE)
    found = summary.daily_summary(df, TARGET, AS_OF, lookback_days=3).collect()
    assert {r.vehicle_id for r in found} == {"V1", "V2", "V4"}


def test_no_events(spark, lake):
    result = summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    assert (result.status, result.reason, result.sample) == ("no_events", "no_partitions", ())
    store(spark, lake, [("V3", "2025-11-09T00:00:00Z", "next", "2025-11-09")])
    result = summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    assert (result.status, result.rows, result.reason) == ("no_events", 0, "outside_window")
    assert [r.vehicle_id for r in result.sample] == ["V3"]
    assert stored(spark, lake) == {}


def test_nulls_stop_the_job_before_it_writes(spark, lake):
    store(spark, lake, [*EXAMPLE, (None, "2025-11-08T10:00:00Z", "x", "2025-11-08")])
    with pytest.raises(summary.BadInput, match="vehicle_id"):
        summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    assert stored(spark, lake) == {}


def test_ties_are_settled_the_same_way_every_time(spark):
    rows = [("V1", "2025-11-08T10:00:00Z", kind, "2025-11-08") for kind in "bca"]
    for _ in range(3):
        df = events(spark, rows).repartition(4)
        assert summary.summarize(df).first().last_event_type == "c"
        rows.reverse()


def test_second_day_keeps_the_first(spark, lake):
    store(spark, lake, EXAMPLE)
    summary.run_daily_summary(spark, lake, date(2025, 11, 8), lateness_hours=None)
    summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    assert {day for _, day in stored(spark, lake)} == {"2025-11-07", "2025-11-08"}


def test_late_arrivals_revise_earlier_days(spark, lake):
    store(spark, lake, EXAMPLE)
    summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    before = stored(spark, lake)
    for _ in range(2):
        summary.revise_summary(spark, lake, [date(2025, 11, 10)])
        after = stored(spark, lake)
        assert after == before | {("V4", "2025-11-08"): (datetime(2025, 11, 8, 12), "too late")}
    # Running the day again does not undo it.
    summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    assert stored(spark, lake) == after


def test_upsert_never_goes_back_in_time(spark, lake):
    newer = events(spark, [("V1", "2025-11-08T12:00:00Z", "newer", "2025-11-08")])
    older = events(spark, [("V1", "2025-11-08T11:00:00Z", "older", "2025-11-08")])
    summary.upsert(spark, summary.summarize(newer), lake.summary)
    summary.upsert(spark, summary.summarize(older), lake.summary)
    assert [v[1] for v in stored(spark, lake).values()] == ["newer"]
    assert summary.upsert(spark, summary.summarize(older.where("false")), lake.summary) == 0


def many_days(spark):
    start = datetime(2025, 11, 1)
    rows = []
    for n in range(400):
        at = start + timedelta(minutes=37 * n)
        arrived = at.date() + timedelta(days=n % 4)
        rows.append((f"V{n % 7}", at.isoformat() + "Z", f"t{n % 5}", arrived.isoformat()))
    return rows


def test_backfill_is_the_union_of_days(spark, zone):
    df = events(spark, many_days(spark)).cache()
    first, last = date(2025, 11, 3), date(2025, 11, 6)
    at_once = summary.backfill(df, first, last, lookback_days=2).collect()
    one_by_one = []
    for n in range(4):
        target = first + timedelta(days=n + 1)
        one_by_one += summary.daily_summary(df, target, lateness_hours=None).collect()
    assert sorted(at_once) == sorted(one_by_one)
    whole = summary.backfill(df, first, last)
    assert whole.select("vehicle_id", "day").distinct().count() == whole.count()
    df.unpersist()


def test_backfill_job_replaces_its_days_only(spark, lake):
    store(spark, lake, EXAMPLE)
    old = events(spark, [("V9", "2025-11-01T00:00:00Z", "kept", "2025-11-01")])
    wrong = events(spark, [("V9", "2025-11-08T00:00:00Z", "replaced", "2025-11-08")])
    summary.upsert(spark, summary.summarize(old.unionByName(wrong)), lake.summary)
    result = summary.run_backfill(spark, lake, date(2025, 11, 7), date(2025, 11, 8))
    assert (result.status, result.rows) == ("success", 4)
    assert {k for k in stored(spark, lake)} == {
        ("V9", "2025-11-01"),
        ("V1", "2025-11-07"),
        ("V1", "2025-11-08"),
        ("V2", "2025-11-08"),
        ("V4", "2025-11-08"),
    }
    none = summary.run_backfill(spark, lake, date(2020, 1, 1), date(2020, 1, 2))
    assert none.status == "no_events"


def test_hot_vehicle_against_brute_force(spark):
    """One vehicle holds a third of the events; the result is that of a plain loop."""
    df = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('V', id % 500) END AS vehicle_id",
        "timestamp_seconds(1762560000 + (id * 7919) % 259200) AS event_time",
        "concat('t', id % 11) AS event_type",
        "concat('s', id % 4) AS event_source",
    ).repartition(6)
    best = {}
    for r in df.select("vehicle_id", F.unix_seconds("event_time").alias("s"), "event_type", "event_source").collect():
        key = (r.vehicle_id, r.s // 86400)
        best[key] = max(best.get(key, ()), (r.s, r.event_type, r.event_source))
    ours = {
        (r.vehicle_id, r.s // 86400): (r.s, r.last_event_type)
        for r in summary.summarize(df)
        .select("vehicle_id", F.unix_seconds("last_event_time").alias("s"), "last_event_type")
        .collect()
    }
    assert ours == {k: v[:2] for k, v in best.items()}


def test_sample(spark):
    df = events(spark, EXAMPLE)
    sample = latest.event_time_sample(df, 2)
    assert [r.event_type for r in sample.collect()] == ["old", "park"]
    assert set(VEHICLE_EVENTS.table.names) == {*df.columns, "_batch_id", "_extra_fields"}


def test_backfill_leaves_no_stale_days(spark, lake):
    store(spark, lake, EXAMPLE)
    stale = spark.createDataFrame([("V7", None, "old", d) for d in ("2025-11-07", "2025-11-08", "2025-11-20")], SUMMARY)
    sinks.overwrite_days(stale, lake.summary)
    summary.run_backfill(spark, lake, date(2025, 11, 7), date(2025, 11, 8), replace_all=True)
    days = {(r.day, r.vehicle_id) for r in read_table(spark, lake.summary, SUMMARY).collect()}
    assert ("2025-11-20", "V7") in days and ("2025-11-07", "V7") not in days and ("2025-11-08", "V7") not in days
    result = summary.run_backfill(spark, lake, date(2025, 11, 20), date(2025, 11, 20), replace_all=True)
    assert result.status == "no_events" and "2025-11-20" not in {d for d, _ in stored(spark, lake)}


def test_the_merge_keeps_to_the_tie_break(spark, lake):
    rows = [("V1", "2025-11-08T10:00:00Z", kind, "2025-11-08") for kind in ("zzz", "aaa")]
    sources = dict(zip(("zzz", "aaa"), ("device", "sensor")))
    for kind in ("aaa", "zzz"):
        df = events(spark, [r for r in rows if r[2] == kind]).withColumn("event_source", F.lit(sources[kind]))
        summary.upsert(spark, summary.candidates(df, ("event_source",)), lake.summary)
    (row,) = summary.stored_summary(spark, lake.summary).collect()
    assert row.last_event_type == "aaa"
