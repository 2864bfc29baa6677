"""Fields that no schema names, and refused records sent through again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import sinks
from fleetlake.operators.drift import json_type
from fleetlake.plans import ingest
from fleetlake.plans.ingest import ledger_table, pending_rejects, rejects_table, replay_rejects, run_ingest
from fleetlake.registry import VEHICLE_EVENTS
from tests.conftest import event
from tests.test_ingest import events_of

S1, S2 = "20251108120000", "20251109120000"


def drift_of(spark, lake):
    return sorted((r.date.isoformat(), r.field, r.type, r.records) for r in ingest.schema_drift(spark, lake).collect())


def test_unknown_fields_are_kept_and_reported(spark, lake, incoming):
    incoming.events(S1, event(speed=1.5, tags=["a"], note=None), event("V2", speed=7), event("V3"))
    incoming.events(S2, event("V4", "2025-11-09T10:00:00Z", speed="fast", deep={"a": {"b": 1}}), event("V5", "2025-11-09T10:00:00Z", flag=True))
    run_ingest(spark, lake, str(incoming))
    assert drift_of(spark, lake) == [
        ("2025-11-08", "note", "null", 1),
        ("2025-11-08", "speed", "integer", 1),
        ("2025-11-08", "speed", "number", 1),
        ("2025-11-08", "tags", "array", 1),
        ("2025-11-09", "deep", "object", 1),
        ("2025-11-09", "flag", "boolean", 1),
        ("2025-11-09", "speed", "string", 1),
    ]
    kept = {r.vehicle_id: r["_extra_fields"] for r in events_of(spark, lake).collect()}
    assert kept["V1"] == {"speed": "1.5", "tags": '["a"]', "note": None} and kept["V3"] is None
    assert kept["V4"] == {"speed": "fast", "deep": '{"a":{"b":1}}'}


def test_files_with_an_odd_record_keep_unknown_fields_too(spark, lake, incoming):
    incoming.put(f"vehicles_events_{S1}.json", {"vehicles_events": [event(speed=1), 7, "text", [1], None, event("V2", event_extra_data="no object")]})
    run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE)
    (row,) = events_of(spark, lake).collect()
    assert row["_extra_fields"] == {"speed": "1"}
    assert sorted(r.reason for r in rejects_table(spark, lake).collect()) == ["bad_record"] * 4 + ["null_required"]


def test_an_object_written_as_text_is_an_object_in_every_file(spark, lake, incoming):
    incoming.events(S1, event(event_extra_data='{"note": "a"}'))
    incoming.events(S2, event("V2", "2025-11-09T10:00:00Z", event_extra_data='{"note": "a"}'), 7)
    run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE)
    assert [r.event_extra_data for r in events_of(spark, lake).collect()] == [{"note": "a"}] * 2


def test_batches_kept_out_report_nothing(spark, lake, incoming):
    incoming.events(S1, event(speed=1), event(None))
    run_ingest(spark, lake, str(incoming), raise_on_failure=False)
    assert drift_of(spark, lake) == []


def test_types_by_their_text(spark):
    texts = {None: "null", "": "string", "1": "integer", "-7": "integer", "1.5": "number", "1e3": "number", "true": "boolean", "x": "string", " {}": "object", "[]": "array"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.k for r in df.select(json_type(F.col("t")).alias("k")).collect()] == list(texts.values())


def known_source(records):
    return records.withColumn("event_source", F.coalesce("event_source", F.lit("unknown")))


@pytest.fixture
def refused(spark, lake, incoming):
    incoming.events(S1, event("V1"), event("V2", source=None, speed=3), event(None), event("V3", time="nope"))
    incoming.put("vehicles_events_20251108120001.json", "{")
    run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE, raise_on_failure=False)
    return lake


def test_replay_loads_what_passes_now_and_once(spark, refused):
    first = replay_rejects(spark, refused, VEHICLE_EVENTS, known_source)
    assert (first.loaded, first.refused) == (1, 2)
    again = replay_rejects(spark, refused, VEHICLE_EVENTS, known_source)
    assert (again.loaded, again.refused) == (0, 2)
    rows = {r.vehicle_id: r for r in events_of(spark, refused).collect()}
    assert set(rows) == {"V1", "V2"} and rows["V2"].event_source == "unknown" and rows["V2"]["_extra_fields"] == {"speed": "3"}
    assert rows["V2"]["_source_file"] == rows["V1"]["_source_file"] and rows["V2"].date == rows["V1"].date
    # The first reject stays, and the replay names it.
    replays = spark.read.parquet(refused.replays).where("outcome = 'ok'").collect()
    (origin,) = rejects_table(spark, refused).where(F.col("reject_id") == replays[0].reject_id).collect()
    assert len(replays) == 1 and (origin.reason, origin.detail) == ("null_required", "event_source")


def test_replay_without_a_new_rule_loads_nothing(spark, refused):
    assert replay_rejects(spark, refused, VEHICLE_EVENTS).loaded == 0
    assert events_of(spark, refused).count() == 1
    assert pending_rejects(spark, refused, VEHICLE_EVENTS).count() == 3


@pytest.mark.parametrize("step", ["append_partitioned", "append_ledger"])
def test_a_crash_in_a_replay_is_settled(spark, refused, monkeypatch, step):
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(sinks, step, lambda *a: (_ for _ in ()).throw(RuntimeError))
        replay_rejects(spark, refused, VEHICLE_EVENTS, known_source)
    replay_rejects(spark, refused, VEHICLE_EVENTS, known_source)
    assert sorted(r.vehicle_id for r in events_of(spark, refused).collect()) == ["V1", "V2"]
    assert pending_rejects(spark, refused, VEHICLE_EVENTS).count() == 2
    assert ledger_table(spark, refused).where("state = 'replayed'").count() == 1


def test_nothing_to_replay(spark, lake):
    assert replay_rejects(spark, lake, VEHICLE_EVENTS).loaded == 0
