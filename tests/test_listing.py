"""What a run lists: marks, overlap, dated folders, bounds on every pass."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta, timezone

import pytest

from fleetlake.functions import times
from fleetlake.plans import ingest
from fleetlake.plans.ingest import list_new, listing_mark, run_ingest
from tests.conftest import event

NOW = datetime.now(timezone.utc)
DAY = timedelta(days=1)


def stamp(moment):
    return moment.strftime("%Y%m%d%H%M%S")


def put(incoming, moment, *records, name=None, content=None):
    """A file made at ``moment``."""
    name = name or f"vehicles_events_{stamp(moment)}.json"
    (incoming.folder / name).parent.mkdir(parents=True, exist_ok=True)
    path = incoming.put(name, {"vehicles_events": list(records)} if content is None else content)
    os.utime(path, (moment.timestamp(), moment.timestamp()))
    return name.rsplit("/", 1)[-1]


def named(listing):
    return {r.file_name for r in listing.files.select("file_name").collect()}


def test_an_incremental_run_goes_back_to_the_mark_less_the_overlap(spark, lake, incoming):
    put(incoming, NOW - 9 * DAY, event(time=(NOW - 9 * DAY).isoformat()))
    newest = NOW - 3 * DAY
    put(incoming, newest, event(time=newest.isoformat()))
    assert run_ingest(spark, lake, str(incoming), incremental=True).first().total_processed == 2
    mark = listing_mark(spark, lake, str(incoming))
    assert abs(mark.mark.timestamp() - newest.timestamp()) < 1
    within = put(incoming, newest - timedelta(hours=20), event("V2", (NOW - 4 * DAY).isoformat()))
    behind = put(incoming, newest - 2 * DAY, event("V3", (NOW - 5 * DAY).isoformat()))
    listed = named(list_new(spark, lake, str(incoming), incremental=True))
    assert within in listed and behind not in listed and len(listed) == 2
    assert run_ingest(spark, lake, str(incoming), incremental=True).first().total_processed == 1
    # What is further behind than the overlap is found by a full listing.
    assert run_ingest(spark, lake, str(incoming)).first().total_processed == 1
    assert run_ingest(spark, lake, str(incoming)).first().total_processed == 0


def test_every_pass_has_the_bound(spark, lake, incoming):
    """Empty and hidden files from before the bound are not looked up either."""
    for name, moment in (("old", NOW - 9 * DAY), ("new", NOW - timedelta(hours=1))):
        put(incoming, moment, name=f"vehicle_events_{name}_empty.json", content="")
        put(incoming, moment, name=f"_vehicle_events_{name}.json", content="{}")
        put(incoming, moment, event(), name=f"vehicle_events_{name}.json")
    listed = named(list_new(spark, lake, str(incoming), modified_after=NOW - DAY))
    assert listed == {"vehicle_events_new_empty.json", "_vehicle_events_new.json", "vehicle_events_new.json"}
    assert len(named(list_new(spark, lake, str(incoming)))) == 6


def test_hidden_files_are_found_as_deep_as_others(spark, lake, incoming):
    put(incoming, NOW, event(), name=f"a/b/vehicles_events_{stamp(NOW)}.json")
    put(incoming, NOW, name="a/c/_hidden.json", content="{}")
    listing = list_new(spark, lake, str(incoming), recursive=True)
    assert (listing.depth, len(named(listing))) == (2, 2)


def test_only_dated_folders_that_can_hold_new_files_are_listed(spark, lake, incoming):
    today, old = NOW.date(), (NOW - 20 * DAY).date()
    put(incoming, NOW - 20 * DAY, event(time=(NOW - 20 * DAY).isoformat()), name=f"{old:%Y/%m/%d}/vehicles_events_{stamp(NOW - 20 * DAY)}.json")
    put(incoming, NOW - timedelta(hours=3), event(time=NOW.isoformat()), name=f"{today:%Y/%m/%d}/vehicles_events_{stamp(NOW)}.json")
    layout = "%Y/%m/%d"
    totals = run_ingest(spark, lake, str(incoming), incremental=True, dated=layout).first()
    assert totals.total_processed == 2 and listing_mark(spark, lake, str(incoming)).depth == 3
    put(incoming, NOW, event("V2", NOW.isoformat()), name=f"{today:%Y/%m/%d}/vehicles_events_{stamp(NOW + timedelta(seconds=1))}.json")
    put(incoming, NOW, event("V3", NOW.isoformat()), name=f"{old:%Y/%m/%d}/vehicles_events_{stamp(NOW + timedelta(seconds=2))}.json")
    listing = list_new(spark, lake, str(incoming), incremental=True, dated=layout)
    assert all(f"{old:%Y/%m/%d}" not in r.path for r in listing.files.collect()) and listing.depth == 3
    assert run_ingest(spark, lake, str(incoming), incremental=True, dated=layout).first().total_processed == 1


def test_no_dated_folder_is_no_error(spark, lake, incoming):
    put(incoming, NOW - 60 * DAY, event(time=(NOW - 60 * DAY).isoformat()), name=f"2020-01-01/vehicles_events_{stamp(NOW - 60 * DAY)}.json")
    run_ingest(spark, lake, str(incoming), incremental=True, dated="%Y-%m-%d")
    assert run_ingest(spark, lake, str(incoming), incremental=True, dated="%Y-%m-%d").first().total_processed == 0


def test_a_clock_ahead_does_not_move_the_mark_beyond_the_run(spark, lake, incoming):
    put(incoming, NOW + 400 * DAY, event(time=NOW.isoformat()), name="vehicle_events_ahead.json")
    run_ingest(spark, lake, str(incoming), incremental=True)
    assert listing_mark(spark, lake, str(incoming)).mark.timestamp() <= times.utc_now().timestamp()
    put(incoming, NOW, event("V2", NOW.isoformat()))
    assert run_ingest(spark, lake, str(incoming), incremental=True).first().total_processed == 1


def test_the_mark_stays_where_it_is_until_a_run_ends(spark, lake, incoming, monkeypatch):
    put(incoming, NOW - 2 * DAY, event(time=(NOW - 2 * DAY).isoformat()))
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(ingest, "load_batch", lambda *a: (_ for _ in ()).throw(RuntimeError))
        run_ingest(spark, lake, str(incoming), incremental=True)
    assert listing_mark(spark, lake, str(incoming)) is None
    assert run_ingest(spark, lake, str(incoming), incremental=True).first().total_processed == 1


def test_failed_files_are_retried_however_old(spark, lake, incoming):
    put(incoming, NOW - 9 * DAY, event(None))
    put(incoming, NOW, event(time=NOW.isoformat()))
    run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE, raise_on_failure=False, incremental=True)
    again = run_ingest(spark, lake, str(incoming), policy=ingest.QUARANTINE, raise_on_failure=False, incremental=True, retry_failed=True)
    assert again.first().total_failed == 1


def test_marks_of_folders_are_their_own(spark, lake, incoming):
    put(incoming, NOW, event(time=NOW.isoformat()), name=f"a/vehicles_events_{stamp(NOW)}.json")
    put(incoming, NOW - 9 * DAY, event("V2", (NOW - 9 * DAY).isoformat()), name=f"b/vehicles_events_{stamp(NOW - 9 * DAY)}.json")
    for folder in "ab":
        assert run_ingest(spark, lake, f"{incoming}/{folder}", incremental=True).first().total_processed == 1
    assert listing_mark(spark, lake, f"{incoming}/a/").mark != listing_mark(spark, lake, f"{incoming}/b").mark


def test_file_days(spark, lake, incoming):
    """A file keeps its day whenever it is listed, with a stamp or without."""
    put(incoming, datetime(2025, 11, 7, 23, 30, tzinfo=timezone.utc), event(), name="vehicle_events_final.json")
    put(incoming, NOW, event(time="2025-11-08T10:00:00Z"), name="vehicles_events_20251108120000.json")
    put(incoming, datetime(2025, 11, 9, tzinfo=timezone.utc), event(), name="vehicles_events_20259999000000.json")
    listing = list_new(spark, lake, str(incoming))
    assert listing.days == [date(2025, 11, 7), date(2025, 11, 8), date(2025, 11, 9)]
