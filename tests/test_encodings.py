"""Files in the encodings that JSON comes in, and what is parsed how often."""

from __future__ import annotations

import json

import pytest

from fleetlake.operators.unnest import unnest
from fleetlake.plans import ingest
from fleetlake.plans.ingest import rejects_table, run_ingest
from fleetlake.registry import VEHICLE_EVENTS
from fleetlake.sources.envelopes import read_envelope_folder
from fleetlake.streaming import ingest as stream_in
from tests.conftest import event
from tests.test_ingest import events_of

ENCODINGS = ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be"]
MARKED = {"utf-16-be": b"\xfe\xff", "utf-32-be": b"\x00\x00\xfe\xff", "utf-16-le": b"\xff\xfe"}


def put(incoming, n, data: bytes):
    path = incoming.folder / f"vehicles_events_2025110812{n:04}.json"
    path.write_bytes(data)
    return path.name


@pytest.mark.parametrize("marked", [False, True])
def test_every_encoding_loads(spark, lake, incoming, marked):
    for n, encoding in enumerate(ENCODINGS):
        text = json.dumps({"vehicles_events": [event(f"Größe 漢字 \U0001f697 {encoding}")]}, ensure_ascii=False)
        put(incoming, n, (MARKED.get(encoding, b"") if marked else b"") + text.encode(encoding))
    totals = run_ingest(spark, lake, str(incoming)).first()
    assert (totals.total_processed, totals.rows_loaded) == (len(ENCODINGS), len(ENCODINGS))
    assert {r.vehicle_id for r in events_of(spark, lake).collect()} == {f"Größe 漢字 \U0001f697 {e}" for e in ENCODINGS}
    assert spark.conf.get("spark.sql.legacy.codingErrorAction") == "false"


def test_one_malformed_file_does_not_end_the_run(spark, lake, incoming):
    whole = json.dumps({"vehicles_events": [event("V1")]})
    put(incoming, 1, whole.encode("utf-16"))
    put(incoming, 2, whole.encode("utf-16")[:-1])
    put(incoming, 3, b"\xff\xfe" + b"\x00\xd8" * 7)
    put(incoming, 4, b"\xc3\x28\xff")
    totals = run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE, raise_on_failure=False).first()
    assert (totals.total_processed, totals.total_failed, totals.rows_loaded) == (1, 3, 1)
    assert {r.reason for r in rejects_table(spark, lake).collect()} == {"corrupt_json"}


def test_streams_decode_too(spark, lake, incoming):
    for n, encoding in enumerate(ENCODINGS):
        put(incoming, n, json.dumps({"vehicles_events": [event(encoding)]}).encode(encoding))
    tagged = stream_in.tagged_stream(spark, str(incoming), VEHICLE_EVENTS)
    stream_in.ingest_stream(tagged, VEHICLE_EVENTS, lake.raw("vehicle_events"), f"{lake.base}/c").awaitTermination()
    assert {r.vehicle_id for r in events_of(spark, lake).collect()} == set(ENCODINGS)


def test_whole_files_are_parsed_once(spark, incoming):
    """A file of declared shape comes as records; only others come as texts."""
    incoming.events("20251108120000", event(), event(None), event(event_value=5))
    incoming.put("vehicles_events_20251108120001.json", {"vehicles_events": [event(), 7], "vehicle_events": [event("V2")]})
    incoming.put("vehicles_events_20251108120002.json", {"vehicles_events": [event()], "vehicle_events": [event("V2")], "more": {"a": [1]}})
    read = read_envelope_folder(spark, str(incoming), VEHICLE_EVENTS)
    how = {r.file_name[-6:-5]: (r.clean is not None, r.vehicles_events is not None) for r in read.collect()}
    assert how == {"0": (True, False), "1": (False, True), "2": (True, False)}
    found = sorted((r["_source_file"][-6:-5], r.vehicle_id, r.event_value, r.file_problem) for r in unnest(read, VEHICLE_EVENTS).fillna("-").collect())
    assert found == [
        ("0", "-", "-", "-"),
        ("0", "V1", "-", "-"),
        ("0", "V1", "5", "-"),
        ("1", "-", "-", "bad_record"),
        ("1", "V1", "-", "-"),
        ("1", "V2", "-", "-"),
        ("2", "V1", "-", "-"),
        ("2", "V2", "-", "-"),
    ]
