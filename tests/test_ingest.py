"""Golden cases over real JSON files."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from fleetlake.functions import times
from fleetlake.operators import quality, sinks
from fleetlake.operators.unnest import unnest
from fleetlake.plans import ingest
from fleetlake.plans.ingest import BatchRejected, ledger_table, rejects_table, run_ingest
from fleetlake.registry import VEHICLE_EVENTS, VEHICLE_STATUS
from fleetlake.sources.envelopes import parse_envelopes, read_envelope_folder, read_envelopes
from fleetlake.sources.listing import list_incoming
from fleetlake.sources.tables import open_table, read_table
from tests.conftest import event, status

S1, S2, S3 = "20251108120000", "20251108130000", "20251109010000"


def events_of(spark, lake):
    return open_table(spark, lake.raw("vehicle_events"), VEHICLE_EVENTS.table, "date")


def reasons(spark, lake):
    rows = rejects_table(spark, lake).groupBy("reason").count().collect()
    return {r.reason: r["count"] for r in rows}


def states(spark, lake):
    rows = ledger_table(spark, lake).collect()
    return {r.file_path.rsplit("/", 1)[1]: (r.state, r.rows) for r in rows if r.state != "started"}


def test_both_types_land_by_arrival_date(spark, lake, incoming, zone):
    incoming.events(S1, event(), event("V2"))
    incoming.events(S3, event("V3", "2025-11-08T23:59:00Z"))
    incoming.put(f"vehicles_status_{S1}.json", {"vehicle_status": [status()]})
    totals = run_ingest(spark, lake, str(incoming)).first()
    assert (totals.total_processed, totals.total_failed, totals.rows_loaded) == (3, 0, 4)
    events = events_of(spark, lake)
    assert {(r.vehicle_id, r.date) for r in events.collect()} == {
        ("V1", date(2025, 11, 8)),
        ("V2", date(2025, 11, 8)),
        ("V3", date(2025, 11, 9)),
    }
    utc = {r.t for r in events.select(times.utc_reading(events, "event_time").alias("t")).collect()}
    assert utc == {datetime(2025, 11, 8, 10, 30), datetime(2025, 11, 8, 23, 59)}
    assert read_table(spark, lake.raw("vehicle_status"), VEHICLE_STATUS.table).count() == 1


def test_both_root_keys_in_one_batch(spark, lake, incoming):
    incoming.events(S1, event(), event("V2"))
    incoming.events(S2, event("V3"), key="vehicle_events")
    run_ingest(spark, lake, str(incoming))
    assert events_of(spark, lake).count() == 3


def test_empty_array_is_no_reject(spark, lake, incoming):
    incoming.events(S1)
    incoming.events(S2, event())
    run_ingest(spark, lake, str(incoming))
    assert states(spark, lake) == {
        f"vehicles_events_{S1}.json": ("processed", 0),
        f"vehicles_events_{S2}.json": ("processed", 1),
    }
    assert reasons(spark, lake) == {}


BROKEN = {
    "vehicles_events_20251108130001.json": ("corrupt_json", '{"vehicles_events": [{"vehicle_id": "V9"'),
    "vehicles_events_20251108130002.json": ("corrupt_json", '{"vehicles_events": "text"}'),
    "vehicles_events_20251108130003.json": ("missing_root_key", {"x": []}),
    "vehicles_events_20251399000000.json": ("bad_stamp", {"vehicles_events": [event("V9")]}),
    "vehicles_events_20251108130004.json": ("null_required", {"vehicles_events": [event(None)]}),
    "vehicles_events_20251108130005.json": ("null_required", {"vehicles_events": [None]}),
    "vehicles_events_20251108130006.json": ("bad_timestamp", {"vehicles_events": [event(time="nope")]}),
}


def test_each_defect_has_its_reason(spark, incoming, zone):
    for name, (_, content) in BROKEN.items():
        incoming.put(name, content)
    folder = read_envelope_folder(spark, str(incoming), VEHICLE_EVENTS)
    tagged = ingest.tagged_records(folder, VEHICLE_EVENTS).collect()
    found = {r["_source_file"].rsplit("/", 1)[1]: r.reason for r in tagged}
    assert found == {name: reason for name, (reason, _) in BROKEN.items()}
    assert len(tagged) == len(BROKEN)


@pytest.mark.parametrize("name", list(BROKEN)[:5:4])
def test_one_bad_file_fails_the_batch(spark, lake, incoming, name):
    reason, content = BROKEN[name]
    incoming.events(S1, event(), event("V2"))
    incoming.put(name, content)
    with pytest.raises(BatchRejected) as failure:
        run_ingest(spark, lake, str(incoming))
    assert failure.value.counts["total_failed"] == 2
    assert events_of(spark, lake).count() == 0
    assert reasons(spark, lake) == {reason: 1}
    assert set(states(spark, lake).values()) == {("failed", 0)}


def test_quarantine_keeps_the_good_rows(spark, lake, incoming):
    incoming.events(S1, event(), event("V2"))
    for name, (_, content) in BROKEN.items():
        incoming.put(name, content)
    totals = run_ingest(
        spark, lake, str(incoming), policy=ingest.QUARANTINE, raise_on_failure=False
    ).first()
    assert (totals.total_processed, totals.total_failed) == (1, 7)
    assert (totals.rows_loaded, totals.rows_rejected, totals.total_schema_errors) == (2, 7, 4)
    assert events_of(spark, lake).count() == 2
    assert sum(reasons(spark, lake).values()) == 7
    (batch,) = ingest.past_batches(spark, lake).collect()
    assert (batch.processed, batch.failed, batch.rows_loaded) == (1, 7, 2)
    assert (batch.rows_rejected, batch.schema_errors) == (7, 4)


def test_rows_in_are_rows_loaded_or_rejected(spark, lake, incoming):
    incoming.events(S1, event(), event(None), event(time="nope"), event("V2"), event(source=None))
    run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE)
    assert events_of(spark, lake).count() == 2
    rejects = {(r.reason, r.detail) for r in rejects_table(spark, lake).collect()}
    assert rejects == {
        ("null_required", "vehicle_id"),
        ("null_required", "event_source"),
        ("bad_timestamp", "nope"),
    }
    kept = rejects_table(spark, lake).where("detail = 'nope'").first().record
    assert '"event_time":"nope"' in kept


def test_second_run_loads_nothing(spark, lake, incoming):
    incoming.events(S1, event())
    run_ingest(spark, lake, str(incoming))
    totals = run_ingest(spark, lake, str(incoming)).first()
    assert (totals.total_processed, totals.rows_loaded) == (0, 0)
    assert events_of(spark, lake).count() == 1
    incoming.events(S2, event("V2"))
    assert run_ingest(spark, lake, str(incoming)).first().rows_loaded == 1
    assert events_of(spark, lake).count() == 2


def test_failed_files_wait_until_asked_for(spark, lake, incoming):
    bad = incoming.events(S1, event(None))
    with pytest.raises(BatchRejected):
        run_ingest(spark, lake, str(incoming))
    incoming.events(S2, event("V2"))
    assert run_ingest(spark, lake, str(incoming)).first().rows_loaded == 1
    assert run_ingest(spark, lake, str(incoming)).first().total_failed == 0
    with pytest.raises(BatchRejected):
        run_ingest(spark, lake, str(incoming), retry_failed=True)
    incoming.put(bad.rsplit("/", 1)[1], {"vehicles_events": [event("V1")]})  # delivered again
    assert run_ingest(spark, lake, str(incoming)).first().rows_loaded == 1
    assert {r.vehicle_id for r in events_of(spark, lake).collect()} == {"V1", "V2"}


def test_unknown_files_are_refused(spark, lake, incoming):
    incoming.events(S1, event())
    incoming.put("trips_20251108120000.json", {"trips": []})
    incoming.put("notes.txt", "not even looked at")
    totals = run_ingest(spark, lake, str(incoming), raise_on_failure=False).first()
    assert (totals.total_processed, totals.total_failed, totals.rows_loaded) == (1, 1, 1)
    assert reasons(spark, lake) == {"unknown_type": 1}
    assert run_ingest(spark, lake, str(incoming)).first().total_failed == 0


def test_one_type_failing_leaves_the_other_alone(spark, lake, incoming):
    incoming.events(S1, event(None))
    incoming.put(f"vehicles_status_{S1}.json", {"vehicles_status": [status()]})
    totals = run_ingest(spark, lake, str(incoming), raise_on_failure=False).first()
    assert (totals.batches_processed, totals.total_processed, totals.total_failed) == (1, 1, 1)


@pytest.mark.parametrize("files_per_read", [2, 1000])
@pytest.mark.parametrize("bad", [False, True])
def test_readers_do_not_change_what_is_loaded(spark, lake, incoming, files_per_read, bad):
    for minute in range(7):
        incoming.events(f"202511081200{minute:02}", event(f"V{minute}"))
    if bad:
        incoming.events(S2, event(None))
    totals = run_ingest(spark, lake, str(incoming), files_per_read=files_per_read, raise_on_failure=False).first()
    loaded = (totals.batches_processed, totals.total_processed, totals.total_failed, totals.rows_loaded)
    assert loaded == ((0, 0, 8, 0) if bad else (1, 7, 0, 7))
    assert events_of(spark, lake).count() == totals.rows_loaded
    if bad:
        reason = {r.reason for r in ledger_table(spark, lake).collect()}
        assert reason == {"batch_failed", "null_required"}


@pytest.mark.parametrize("bad", [False, True])
def test_many_readers_take_several_jobs_and_one_decision(spark, lake, incoming, monkeypatch, bad):
    readers, read = [], ingest.read_envelopes
    monkeypatch.setattr(ingest, "READERS_PER_JOB", 2)
    monkeypatch.setattr(ingest, "read_envelopes", lambda s, paths, *more: readers.append(len(paths)) or read(s, paths, *more))
    for minute in range(7):
        incoming.events(f"202511081200{minute:02}", event(f"V{minute}", extra=1))
    incoming.put("vehicles_events_20251108120100.json", "" if bad else {"vehicles_events": [event("V7")]})
    totals = run_ingest(spark, lake, str(incoming), files_per_read=1, raise_on_failure=False).first()
    assert readers == ([2, 2, 2, 1] if bad else [2, 2, 2, 2])
    assert (totals.total_processed, totals.total_failed, totals.rows_loaded) == ((0, 8, 0) if bad else (8, 0, 8))
    assert events_of(spark, lake).count() == totals.rows_loaded
    assert sum(r.records for r in ingest.schema_drift(spark, lake).collect()) == (0 if bad else 7)


def test_file_without_stamp_gets_the_ingest_date(spark, lake, incoming):
    incoming.put("backup vehicle_events 20.json", {"vehicle_events": [event()]})
    run_ingest(spark, lake, str(incoming), ingest_date=date(2025, 12, 24))
    assert events_of(spark, lake).first().date == date(2025, 12, 24)
    assert run_ingest(spark, lake, str(incoming)).first().rows_loaded == 0


def test_extra_data_may_change_shape(spark, lake, incoming):
    incoming.events(S1, event(event_extra_data={"note": "a", "boot_time": None}))
    run_ingest(spark, lake, str(incoming))
    incoming.events(S2, event("V2", event_value=95, event_extra_data={"boot_time": 5, "emergency_call": True}))
    run_ingest(spark, lake, str(incoming))
    rows = {r.vehicle_id: r for r in events_of(spark, lake).collect()}
    assert rows["V1"].event_extra_data == {"note": "a", "boot_time": None}
    assert rows["V2"].event_extra_data == {"boot_time": "5", "emergency_call": "true"}
    assert rows["V2"].event_value == "95"


def test_ledger_is_recovered_from_the_lake(spark, lake, incoming):
    incoming.events(S1, event(), event("V2"))
    incoming.events(S2, event("V3"))
    folder = read_envelope_folder(spark, str(incoming), VEHICLE_EVENTS)
    tagged = ingest.tagged_records(folder, VEHICLE_EVENTS)
    # As after a crash: the rows are there, the ledger is not.
    sinks.append_partitioned(quality.good(tagged, VEHICLE_EVENTS), lake.raw("vehicle_events"))
    added = ingest.recover_ledger(spark, lake, VEHICLE_EVENTS, [date(2025, 11, 8)])
    assert sorted(r.rows for r in added.collect()) == [1, 2]
    assert run_ingest(spark, lake, str(incoming)).first().rows_loaded == 0
    assert events_of(spark, lake).count() == 3
    assert ingest.recover_ledger(spark, lake, VEHICLE_EVENTS, [date(2025, 11, 8)]).count() == 0


def test_records_are_counted_without_sorting_them(spark):
    rows = [("a", "ok"), ("a", "ok"), ("a", "null_required"), ("a", "bad_record"), ("b", "ok")]
    tagged = spark.createDataFrame(rows, "_source_file string, reason string")
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "file_path string")
    counts = ingest._file_counts(listed, tagged)
    expected = {"a": (2, 2, "bad_record"), "b": (1, 0, None), "c": (0, 0, None)}
    assert {r.file_path: (r.good, r.bad, r.first_reason) for r in counts.collect()} == expected
    plan = counts._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert "HashAggregate" in [line for line in plan if "Aggregate" in line][-1]  # the one next to the records


@pytest.mark.parametrize("dates", [3, 40])
def test_a_partitioned_write_keeps_few_files_open_and_sorts_only_beyond(spark, tmp_path, monkeypatch, dates):
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: seen.append(spark.conf.get(key)) or write(*a, **k))
    before = spark.conf.get(key)
    rows = spark.range(400, numPartitions=1).selectExpr("id", f"date_add(date'2025-01-01', int(id % {dates})) AS day")
    assert sinks.append_partitioned(rows, str(tmp_path / "t"), "day", by_partition=False) == 400
    assert sinks.overwrite_days(rows, str(tmp_path / "t")) == 400
    assert seen == [str(sinks.OPEN_WRITERS)] * 2
    assert spark.conf.get(key) == before
    stored = read_table(spark, str(tmp_path / "t"), rows.schema)
    assert sorted(stored.collect()) == sorted(rows.collect())


def test_given_paths_are_looked_up_by_few_tasks(spark, incoming):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, tracker = spark.conf.get(key), spark.sparkContext.statusTracker()
    paths = [incoming.events(f"20251108{minute // 60:02}{minute % 60:02}00", event(f"V{minute}")) for minute in range(60)]
    spark.sparkContext.setJobGroup("few-listing-tasks", "paths given to a reader")
    try:
        read = read_envelopes(spark, paths, VEHICLE_EVENTS)
        stages = [s for job in tracker.getJobIdsForGroup("few-listing-tasks") for s in tracker.getJobInfo(job).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tracker.getStageInfo(s).numTasks for s in stages] == [4 * spark.sparkContext.defaultParallelism]
    assert read.count() == 60
    assert spark.conf.get(key) == before


def test_only_listed_paths_are_read(spark, incoming):
    listed = [incoming.events(S1, event()), incoming.events(S2, event("V2"))]
    incoming.events(S3, event("V3"))
    rows = unnest(read_envelopes(spark, listed, VEHICLE_EVENTS), VEHICLE_EVENTS).collect()
    assert {r.vehicle_id for r in rows} == {"V1", "V2"}
    with pytest.raises(AnalysisException):
        read_envelopes(spark, [f"{incoming}/absent.json"], VEHICLE_EVENTS)


def test_names_that_look_like_patterns(spark, lake, incoming):
    incoming.put("vehicle_events[1].json", {"vehicle_events": [event()]})
    incoming.put("vehicle_events{a,b}.json", {"vehicle_events": [event("V2")]})
    assert run_ingest(spark, lake, str(incoming)).first().rows_loaded == 2


def test_listing_looks_into_folders_only_when_asked(spark, incoming):
    incoming.events(S1, event())
    (incoming.folder / "deeper").mkdir()
    incoming.put(f"deeper/vehicles_events_{S2}.json", {"vehicles_events": []})
    assert list_incoming(spark, str(incoming)).count() == 1
    assert list_incoming(spark, str(incoming), recursive=True).count() == 2


def test_listing_by_modification_time(spark, incoming, zone):
    incoming.events(S1, event())
    now = times.utc_now()
    hour = times.timedelta(hours=1)
    assert list_incoming(spark, str(incoming), modified_after=now - hour).count() == 1
    assert list_incoming(spark, str(incoming), modified_after=now + hour).count() == 0


def test_text_and_files_give_the_same_records(spark, incoming):
    paths = [
        incoming.events(S1, event(), event(None)),
        incoming.put(f"vehicles_events_{S2}.json", "{"),
        incoming.put(f"vehicles_events_{S3}.json", {"y": 1}),
    ]
    from_files = ingest.tagged_records(read_envelopes(spark, paths, VEHICLE_EVENTS), VEHICLE_EVENTS)
    texts = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("content")
    )
    from_text = ingest.tagged_records(parse_envelopes(texts, VEHICLE_EVENTS), VEHICLE_EVENTS)
    assert sorted(from_files.collect(), key=repr) == sorted(from_text.collect(), key=repr)


def test_append_counts_its_rows(spark, lake):
    df = spark.range(10).select("id", F.lit("2025-11-08").cast("date").alias("date"))
    assert sinks.append_partitioned(df, f"{lake.base}/t") == 10
    assert sinks.append_partitioned(df, f"{lake.base}/t", by_partition=True) == 10
    assert spark.read.parquet(f"{lake.base}/t").count() == 20


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert quality.null_counts(df, ["x", "y"]).first().asDict() == {"x": 1, "y": 2}
    present = {r.column: r.present for r in quality.required_columns(df, ["x", "y", "z"]).collect()}
    assert present == {"x": True, "y": False, "z": False}
    with pytest.raises(quality.SchemaMismatch):
        quality.require_columns(df, ["x", "z"])


def test_unknown_policy(spark, lake, incoming):
    with pytest.raises(ValueError):
        run_ingest(spark, lake, str(incoming), policy="maybe")


def test_nothing_vanishes(spark, lake, incoming):
    """Both keys in one file, a second value, an odd record, an empty file, hidden files: loaded or refused."""
    incoming.put(f"vehicles_events_{S1}.json", {"vehicles_events": [event()], "vehicle_events": [event("V2")]})
    incoming.put(f"vehicles_events_{S2}.json", json.dumps({"vehicles_events": [event("V3")]}) * 2)
    incoming.put("vehicles_events_20251108140000.json", {"vehicles_events": [event("V4"), event("V5", event_extra_data="text"), event("V6"), 7]})
    incoming.put("vehicles_events_20251108150000.json", "")
    incoming.put("_vehicles_events_20251108160000.json", {"vehicles_events": [event("V7")]})
    incoming.put(".vehicles_events_20251108160000.json", "")
    incoming.put("vehicles_events_20251108170000.json", [{"vehicles_events": [event("V8")]}, {"vehicle_events": [event("V9")]}])
    totals = run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE, raise_on_failure=False).first()
    assert {r.vehicle_id for r in events_of(spark, lake).collect()} == {"V1", "V2", "V4", "V6", "V8", "V9"}
    assert reasons(spark, lake) == {"corrupt_json": 1, "bad_record": 2, "empty_file": 1, "unknown_type": 2}
    assert (totals.rows_loaded, totals.rows_rejected) == (6, 6)
    shown = rejects_table(spark, lake).where("reason in ('corrupt_json', 'bad_record')").collect()
    assert all(r.record for r in shown)
    assert run_ingest(spark, lake, str(incoming), raise_on_failure=False).first().total_failed == 0


def test_a_name_delivered_again_is_loaded(spark, lake, incoming):
    incoming.put("backup_vehicle_events_final.json", {"vehicle_events": [event()]})
    run_ingest(spark, lake, str(incoming), ingest_date=date(2025, 11, 9))
    incoming.put("backup_vehicle_events_final.json", {"vehicle_events": [event("V2"), event("V3")]})
    assert run_ingest(spark, lake, str(incoming), ingest_date=date(2025, 11, 9)).first().rows_loaded == 2
    assert events_of(spark, lake).count() == 3


class Crash(Exception):
    pass


@pytest.mark.parametrize("partly", [False, True])
def test_a_crash_before_the_last_ledger_rows_is_settled(spark, lake, incoming, monkeypatch, partly):
    incoming.events(S1, event(), event("V2"))
    incoming.events(S3, event("V3"))
    append = sinks.append_partitioned

    def crash(df, *more, **named):
        append(df.where("vehicle_id = 'V1'") if partly else df, *more, **named)
        raise Crash

    with monkeypatch.context() as patched, pytest.raises(Crash):
        patched.setattr(sinks, "append_partitioned", crash)
        run_ingest(spark, lake, str(incoming))
    totals = run_ingest(spark, lake, str(incoming)).first()
    assert totals.rows_loaded == (3 if partly else 0)
    assert sorted(r.vehicle_id for r in events_of(spark, lake).collect()) == ["V1", "V2", "V3"]
    assert run_ingest(spark, lake, str(incoming)).first().total_processed == 0
