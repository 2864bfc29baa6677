from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import quality
from fleetlake.plans import summary
from fleetlake.registry import REJECTS, VEHICLE_EVENTS
from fleetlake.sources.envelopes import read_envelope_folder
from fleetlake.sources.tables import StreamedTable, create_tables, read_table, scan_partitions
from fleetlake.plans.ingest import tagged_records
from fleetlake.streaming import ingest as stream_in
from fleetlake.streaming import summary as stream_out
from tests.conftest import event, status

S1, S2 = "20251108120000", "20251109120000"


def run_ingest_stream(spark, incoming, lake):
    tagged = stream_in.tagged_stream(spark, str(incoming), VEHICLE_EVENTS)
    path, checkpoint = lake.raw("vehicle_events"), f"{lake.base}/checkpoint"
    stream_in.ingest_stream(tagged, VEHICLE_EVENTS, path, checkpoint).awaitTermination()
    rejects = stream_in.reject_stream(tagged, VEHICLE_EVENTS, lake.rejects, f"{lake.base}/checkpoint-rejects")
    rejects.awaitTermination()


def test_each_file_lands_once(spark, lake, incoming):
    incoming.events(S1, event(), event("V2"), event(None))
    incoming.events(S2, event("V3"), key="vehicle_events")
    for _ in range(2):
        run_ingest_stream(spark, incoming, lake)
        rows = read_table(spark, lake.raw("vehicle_events"), VEHICLE_EVENTS.table).collect()
        assert {(r.vehicle_id, r.date) for r in rows} == {
            ("V1", date(2025, 11, 8)),
            ("V2", date(2025, 11, 8)),
            ("V3", date(2025, 11, 9)),
        }
        assert len(rows) == 3
        rejects = spark.read.parquet(lake.rejects).collect()
        assert [(r.reason, r.detail) for r in rejects] == [("null_required", "vehicle_id")]
    incoming.events("20251110120000", event("V4"))
    run_ingest_stream(spark, incoming, lake)
    assert read_table(spark, lake.raw("vehicle_events"), VEHICLE_EVENTS.table).count() == 4


def run_summary_stream(spark, incoming, lake):
    tagged = stream_in.tagged_stream(spark, str(incoming), VEHICLE_EVENTS)
    changes = stream_out.last_per_vehicle_day_stream(quality.good(tagged, VEHICLE_EVENTS))
    stream_out.summary_stream(changes, lake.summary, f"{lake.base}/checkpoint").awaitTermination()
    return {
        (r.vehicle_id, r.day, r.last_event_type)
        for r in summary.stored_summary(spark, lake.summary).collect()
    }


def test_summary_stream_equals_the_batch_until_rows_are_too_late(spark, lake, incoming, zone):
    incoming.events(S1, event(time="2025-11-08T10:00:00Z", kind="a"), event("V2", kind="b"))
    first = run_summary_stream(spark, incoming, lake)
    assert first == {("V1", "2025-11-08", "a"), ("V2", "2025-11-08", "b")}

    # Late for its day, but the day's end is not yet 48 hours behind.
    incoming.events(
        "20251110210000",
        event(time="2025-11-10T20:00:00Z", kind="d"),
        event(time="2025-11-08T23:00:00Z", kind="c"),
    )
    second = run_summary_stream(spark, incoming, lake)
    assert second == {
        ("V1", "2025-11-08", "c"),
        ("V2", "2025-11-08", "b"),
        ("V1", "2025-11-10", "d"),
    }
    batch = summary.summarize(
        quality.good(
            tagged_records(read_envelope_folder(spark, str(incoming), VEHICLE_EVENTS), VEHICLE_EVENTS),
            VEHICLE_EVENTS,
        )
    )
    assert {(r.vehicle_id, r.day, r.last_event_type) for r in batch.collect()} == second

    # Two and a half days on, the eighth is closed.
    incoming.events("20251113120000", event(time="2025-11-13T12:00:00Z", kind="e"))
    run_summary_stream(spark, incoming, lake)
    incoming.events("20251114120000", event(time="2025-11-08T23:30:00Z", kind="too late"))
    last = run_summary_stream(spark, incoming, lake)
    assert last == second | {("V1", "2025-11-13", "e")}


def test_a_wrong_date_in_the_future_does_not_close_days(spark, lake, incoming):
    incoming.events(S1, event(kind="a"), event("V9", "2099-01-01T00:00:00Z"))
    run_summary_stream(spark, incoming, lake)
    incoming.events(S2, event("V2", kind="b"))
    assert run_summary_stream(spark, incoming, lake) == {("V1", "2025-11-08", "a"), ("V2", "2025-11-08", "b")}


def test_streams_sort_files_by_name_like_the_batch(spark, lake, incoming):
    incoming.events(S1, event())
    incoming.put(f"VEHICLES_EVENTS_{S2}.JSON", {"vehicles_events": [event("V2")]})
    incoming.put(f"vehicles_status_{S1}.json", {"vehicles_status": [status()]})
    incoming.put(f"trips_{S1}.json", {"vehicles_events": [event("V3")]})
    tagged = stream_in.tagged_stream(spark, str(incoming), VEHICLE_EVENTS, refuse_unknown=True)
    stream_in.ingest_stream(tagged, VEHICLE_EVENTS, lake.raw("vehicle_events"), f"{lake.base}/c1").awaitTermination()
    stream_in.reject_stream(tagged, VEHICLE_EVENTS, lake.rejects, f"{lake.base}/c2").awaitTermination()
    events = read_table(spark, lake.raw("vehicle_events"), VEHICLE_EVENTS.table)
    assert {r.vehicle_id for r in events.collect()} == {"V1", "V2"}
    rejects = read_table(spark, lake.rejects, REJECTS).collect()
    assert [(r.reason, r.file_type) for r in rejects] == [("unknown_type", "vehicle_events")]


def test_files_that_no_commit_names_are_not_read(spark, lake, incoming):
    incoming.events(S1, event(kind="a"))
    tagged = stream_in.tagged_stream(spark, str(incoming), VEHICLE_EVENTS)
    path = lake.raw("vehicle_events")
    stream_in.ingest_stream(tagged, VEHICLE_EVENTS, path, f"{lake.base}/c").awaitTermination()
    stray = read_table(spark, path, VEHICLE_EVENTS.table).drop("date").withColumn("event_type", F.lit("stray"))
    stray.write.mode("append").parquet(f"{path}/date=2025-11-08")
    found = scan_partitions(spark, path, VEHICLE_EVENTS.table, ["2025-11-08", "2025-11-09"])
    assert [r.event_type for r in found.collect()] == ["a"]
    with pytest.raises(StreamedTable):
        create_tables(spark, lake, ("streamed_raw", "streamed_reports"))
