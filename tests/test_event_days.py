"""The index of event days: which partitions a backfill reads."""

from __future__ import annotations

from datetime import date

from fleetlake.operators import event_days, sinks
from fleetlake.plans import summary
from fleetlake.plans.ingest import run_ingest
from fleetlake.registry import VEHICLE_EVENTS
from tests.conftest import event
from tests.test_changes import kinds
from tests.test_summary import events, store

D = [date(2025, 11, n) for n in range(31)[1:]]


def may_hold(spark, lake, first, last=None):
    found = event_days.partitions_with(spark, lake, VEHICLE_EVENTS, first, last or first)
    return [int(d[-2:]) for d in found]


def test_a_backfill_reads_the_partitions_that_can_hold_its_days(spark, lake, incoming):
    incoming.events("20251108120000", event(time="2025-11-08T10:00:00Z"))
    incoming.events("20251109120000", event(time="2025-11-09T10:00:00Z"), event("V2", "2025-11-08T23:00:00Z", kind="late"))
    run_ingest(spark, lake, str(incoming))
    incoming.events("20251110120000", event(time="2025-11-10T10:00:00Z"))
    incoming.events("20251111120000", event(time="2025-11-11T10:00:00Z"), event("V3", "2025-11-08T01:00:00Z", kind="very late"))
    run_ingest(spark, lake, str(incoming))
    assert may_hold(spark, lake, D[7]) == [8, 9, 11]
    assert may_hold(spark, lake, D[9]) == [10, 11]
    assert may_hold(spark, lake, D[4]) == [] and may_hold(spark, lake, D[11], D[20]) == []
    read = summary._events_of_days(spark, lake, D[7], D[7], None)
    assert sorted({f.split("date=")[1][:10] for f in read.inputFiles()}) == ["2025-11-08", "2025-11-09", "2025-11-11"]
    assert {f.split("date=")[1][:10] for f in summary._events_of_days(spark, lake, D[7], D[7], 2).inputFiles()} == {"2025-11-08", "2025-11-09"}
    summary.run_backfill(spark, lake, D[7], D[7])
    assert kinds(spark, lake) == {("V1", "2025-11-08"): "start_drive", ("V2", "2025-11-08"): "late", ("V3", "2025-11-08"): "very late"}


def test_partitions_from_before_the_index_count_as_holding_anything(spark, lake, incoming):
    store(spark, lake, [("V9", "2025-11-01T10:00:00Z", "old", "2025-11-05"), ("V9", "2025-11-06T10:00:00Z", "x", "2025-11-06")])
    assert may_hold(spark, lake, D[0]) == [5, 6]
    incoming.events("20251106120000", event(time="2025-11-06T11:00:00Z"))
    incoming.events("20251108120000", event(time="2025-11-08T10:00:00Z"))
    run_ingest(spark, lake, str(incoming))
    assert may_hold(spark, lake, D[0]) == [5, 6] and may_hold(spark, lake, D[7]) == [5, 6, 8]


def test_rows_appended_by_hand_can_be_recorded(spark, lake, incoming):
    incoming.events("20251108120000", event(time="2025-11-08T10:00:00Z"))
    run_ingest(spark, lake, str(incoming))
    more = events(spark, [("V9", "2025-11-02T10:00:00Z", "old", "2025-11-08")])
    event_days.record(lake, more, VEHICLE_EVENTS, "by hand")
    sinks.append_partitioned(more, lake.raw("vehicle_events"))
    assert may_hold(spark, lake, D[1]) == [8]


def test_the_index_stays_small(spark, lake):
    for n in range(40):
        event_days.record(lake, events(spark, [("V", "2025-11-08T10:00:00Z", "k", "2025-11-08")]).coalesce(1), VEHICLE_EVENTS, f"b{n}")
    assert len(sinks.partition_files(spark, lake.event_days, "file_type", "vehicle_events")) <= event_days.INDEX_FILES + 1
    assert may_hold(spark, lake, D[7]) == []
