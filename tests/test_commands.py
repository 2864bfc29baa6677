from __future__ import annotations

import pytest

from fleetlake.__main__ import arguments, run
from fleetlake.registry import SUMMARY
from fleetlake.sources.tables import read_table
from tests.conftest import event


def test_from_files_to_report(spark, lake, incoming, capsys):
    incoming.events("20251108120000", event(), event("V2", "2025-11-08T23:00:00Z"))
    for command in (
        ["ingest", str(incoming), "--incremental"],
        ["compact", "--before", "2025-11-09"],
        ["backfill", "--start-date", "2025-11-01", "--end-date", "2025-11-08"],
        ["views"],
        ["summary", "2025-11-09"],
    ):
        run(spark, arguments(["--lake", lake.base, *command]))
    printed = capsys.readouterr().out
    assert "daily_summary" in printed
    assert "no_events" in printed  # by now that day is more than 48 hours ago
    assert read_table(spark, lake.summary, SUMMARY).count() == 2
    assert spark.sql("SELECT * FROM reports.daily_summary WHERE day = '2025-11-08'").count() == 2


def test_bad_arguments():
    with pytest.raises(SystemExit):
        arguments(["--lake", "x", "backfill", "--start-date", "yesterday"])
    with pytest.raises(SystemExit):
        arguments(["ingest", "folder"])
