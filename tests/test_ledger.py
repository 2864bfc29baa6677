"""The ledger: pruned by day, gathered, and right after a crash."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import sinks
from fleetlake.plans import ingest
from fleetlake.plans.ingest import compact_ledger, ledger_of_days, ledger_table, open_batch_rows, run_ingest
from fleetlake.registry import LEDGER
from tests.conftest import event
from tests.test_lake import plan_of

DAY = date(2025, 11, 8)


def rows(spark, *files, day=DAY, state="processed"):
    at = datetime(2025, 11, 8)
    return spark.createDataFrame([(f, state, 1, "b", at, 10, at, day, None, "vehicle_events", day) for f in files], LEDGER)


def test_only_the_days_asked_for_are_listed_and_read(spark, lake):
    for n in range(5):
        sinks.append_ledger(rows(spark, f"f{n}", day=DAY + timedelta(days=n)), lake.ledger)
    sinks.append_ledger(rows(spark, "unknown", day=None), lake.ledger)
    some = ledger_of_days(spark, lake, [DAY + timedelta(days=1), date(2030, 1, 1)])
    assert {r.file_path for r in some.collect()} == {"f1", "unknown"}
    assert len(some.inputFiles()) == 2
    assert "file_day=" in plan_of(some)
    assert ledger_table(spark, lake).count() == 6


def test_many_runs_leave_few_files(spark, lake):
    for n in range(50):
        sinks.append_ledger(rows(spark, f"f{n}").coalesce(1), lake.ledger)
        compact_ledger(spark, lake, [DAY], max_files=8)
        assert len(sinks.partition_files(spark, lake.ledger, "file_day", DAY.isoformat())) <= 9
    assert sorted(r.file_path for r in ledger_table(spark, lake).collect()) == sorted(f"f{n}" for n in range(50))


def test_days_with_few_files_are_left_alone(spark, lake):
    for n in range(3):
        sinks.append_ledger(rows(spark, f"f{n}", day=DAY + timedelta(days=n)), lake.ledger)
    days = [DAY + timedelta(days=n) for n in range(3)]
    assert compact_ledger(spark, lake, days, max_files=1) == []
    sinks.append_ledger(rows(spark, "more"), lake.ledger)
    assert compact_ledger(spark, lake, days, max_files=1) == [DAY.isoformat()]


def test_a_crash_in_a_compaction_loses_and_counts_nothing_twice(spark, lake, incoming, monkeypatch):
    for minute in range(3):
        incoming.events(f"202511081200{minute:02}", event(f"V{minute}"))
        run_ingest(spark, lake, str(incoming))
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(sinks, "delete_files", lambda *a: (_ for _ in ()).throw(RuntimeError))
        compact_ledger(spark, lake, [DAY], max_files=1)
    assert ledger_table(spark, lake).count() == 6
    assert sum(b.processed for b in ingest.past_batches(spark, lake).collect()) == 3
    assert run_ingest(spark, lake, str(incoming)).first().total_processed == 0
    compact_ledger(spark, lake, [DAY], max_files=1)
    assert ledger_table(spark, lake).count() == 3


def test_no_batch_is_open_between_runs(spark, lake, incoming):
    incoming.events("20251108120000", event())
    run_ingest(spark, lake, str(incoming))
    assert open_batch_rows(spark, lake).count() == 0


def test_a_crash_after_the_ledger_was_written_is_no_open_batch(spark, lake, incoming, monkeypatch):
    incoming.events("20251108120000", event())
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(sinks, "drop_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError))
        run_ingest(spark, lake, str(incoming))
    assert open_batch_rows(spark, lake).count() == 1
    assert ingest.settle_open_batches(spark, lake) == []
    assert open_batch_rows(spark, lake).count() == 0
    assert ledger_table(spark, lake).where(F.col("state") == "processed").count() == 1
    assert run_ingest(spark, lake, str(incoming)).first().total_processed == 0


def test_a_file_without_stamp_is_known_on_later_days(spark, lake, incoming):
    incoming.put("backup_vehicle_events_final.json", {"vehicle_events": [event()]})
    assert run_ingest(spark, lake, str(incoming), ingest_date=date(2025, 11, 9)).first().rows_loaded == 1
    for later in (date(2025, 11, 10), date(2026, 3, 1)):
        assert run_ingest(spark, lake, str(incoming), ingest_date=later).first().total_processed == 0
