from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import names
from fleetlake.operators import files

CASES = [
    ("vehicles_events_20251108120000.json", "vehicle_events", "strict", date(2025, 11, 8)),
    ("vehicle_events_20251108120000.json", "vehicle_events", "strict", date(2025, 11, 8)),
    ("vehicles_status_20251108235959.json", "vehicle_status", "strict", date(2025, 11, 8)),
    ("VEHICLES_EVENTS_20251108120000.JSON", "vehicle_events", "strict", date(2025, 11, 8)),
    # Contains a type in the singular: accepted.  In the plural: not.
    ("backup_vehicle_events_final.json", "vehicle_events", "fallback", date(2030, 1, 1)),
    ("vehicles_events_latest.json", "unknown", "none", date(2030, 1, 1)),
    ("vehicle_status_vehicle_events.json", "vehicle_events", "fallback", date(2030, 1, 1)),
    ("vehicle_events_2025110812.json", "vehicle_events", "fallback", date(2030, 1, 1)),
    ("trips_20251108120000.json", "unknown", "none", date(2025, 11, 8)),
    # Not a month, not an hour, not a day of that year.
    ("vehicles_events_20251399000000.json", "vehicle_events", "strict", None),
    ("vehicles_events_20251108240000.json", "vehicle_events", "strict", None),
    ("vehicles_events_20250229120000.json", "vehicle_events", "strict", None),
    ("vehicles_events_20240229120000.json", "vehicle_events", "strict", date(2024, 2, 29)),
    # An hour that New York skips is still a valid stamp.
    ("vehicles_events_20240310023000.json", "vehicle_events", "strict", date(2024, 3, 10)),
    # The first fourteen digits count.
    ("a_20251108120000_20251109120000_vehicle_status.json", "vehicle_status", "fallback", date(2025, 11, 8)),
]


def test_classify(spark, zone):
    df = spark.createDataFrame([(c[0],) for c in CASES], "file_name string")
    rows = files.classify(df, F.lit(date(2030, 1, 1))).collect()
    assert [(r.file_name, r.file_type, r.match_kind, r.date) for r in rows] == CASES


def test_group_by_type(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "file_name string")
    counts = {r.file_type: r.files for r in files.group_by_type(files.classify(df)).collect()}
    assert counts == {"vehicle_events": 11, "vehicle_status": 2, "unknown": 2}


@pytest.mark.parametrize(
    "uri, name",
    [
        ("file:/a/b.json", "b.json"),
        ("file:/a/b%20c+d.json", "b c+d.json"),
        ("s3://bucket/x/%2520y.json", "%20y.json"),
    ],
)
def test_name_of_uri(spark, uri, name):
    df = spark.createDataFrame([(uri,)], "uri string")
    assert df.select(names.base_name(names.decoded(F.col("uri"))).alias("n")).first().n == name


def test_not_loaded(spark):
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "file_path string")
    ledger = spark.createDataFrame([("a", "processed"), ("b", "failed")], "file_path string, state string")
    assert {r.file_path for r in files.not_loaded(listing, ledger).collect()} == {"c"}
    again = files.not_loaded(listing, ledger, retry_failed=True)
    assert {r.file_path for r in again.collect()} == {"b", "c"}
