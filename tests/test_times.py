from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from fleetlake.functions import times
from fleetlake.plans.summary import target

TEXTS = [
    ("2025-11-08T10:30:00Z", datetime(2025, 11, 8, 10, 30)),
    ("2025-11-08T10:30:00.000001Z", datetime(2025, 11, 8, 10, 30, 0, 1)),
    ("2025-11-08 10:30:00", datetime(2025, 11, 8, 10, 30)),
    ("2025-11-08T23:30:00+02:00", datetime(2025, 11, 8, 21, 30)),
    ("2025-11-08T23:30:00-0500", datetime(2025, 11, 9, 4, 30)),
    ("2025-11-08 10:30:00 America/New_York", datetime(2025, 11, 8, 15, 30)),
    ("2025-11-08", datetime(2025, 11, 8)),
    # Both of these are 01:30 in New York, an hour apart.
    ("2024-11-03T05:30:00Z", datetime(2024, 11, 3, 5, 30)),
    ("2024-11-03T06:30:00Z", datetime(2024, 11, 3, 6, 30)),
    # New York has no such local time.
    ("2024-03-10T02:30:00", datetime(2024, 3, 10, 2, 30)),
    ("2024-07-10T02:30:00", datetime(2024, 7, 10, 2, 30)),
    ("1960-01-01T00:00:00.5Z", datetime(1960, 1, 1, 0, 0, 0, 500000)),
    ("nope", None),
    ("", None),
    ("10:30", None),
    ("2025", None),
    ("2025-11-08T25:30:00Z", None),
    ("2025-02-30T10:00:00Z", None),
    (None, None),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_instant(spark, zone, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(t[0],) for t in TEXTS], "text string")
        df = df.withColumn("at", times.parse_instant(F.col("text")))
        assert df.schema["at"].dataType == TimestampType()
        rows = df.select("text", times.utc_reading(df, "at").alias("utc")).collect()
        assert [(r.text, r.utc) for r in rows] == TEXTS
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_event_day_is_the_utc_day(spark, zone):
    df = spark.createDataFrame([("2025-11-08T02:30:00Z",), ("2025-11-07T23:59:59.999999Z",)], "text string")
    df = df.withColumn("at", times.parse_instant(F.col("text")))
    assert [r.day for r in df.select(times.event_day(df, "at").alias("day")).collect()] == [
        "2025-11-08",
        "2025-11-07",
    ]


def test_round_trip(spark, zone):
    df = spark.sql("SELECT timestamp_ntz'2024-11-03 01:30:00.25' AS wall")
    there = df.withColumn("at", times.utc_to_instant(F.col("wall")))
    back = there.select(times.utc_reading(there, "at").alias("back")).first().back
    assert back == datetime(2024, 11, 3, 1, 30, 0, 250000)


def test_literals_have_the_columns_type(spark, zone):
    moment = datetime(2024, 11, 3, 6, 30, tzinfo=timezone.utc)
    df = spark.range(1).select(
        times.time_literal(moment, TimestampType()).alias("a"),
        times.time_literal(moment, TimestampNTZType()).alias("b"),
    )
    assert df.schema["a"].dataType == TimestampType()
    assert df.schema["b"].dataType == TimestampNTZType()
    row = df.select(F.unix_micros("a").alias("a"), "b").first()
    assert row.a == int(moment.timestamp()) * 1_000_000
    assert row.b == datetime(2024, 11, 3, 6, 30)


def test_text_is_not_a_time(spark):
    with pytest.raises(TypeError):
        times.utc_reading(spark.sql("SELECT '2024' AS x"), "x")


def test_target_date():
    assert target("2025-11-09") == date(2025, 11, 9)
    assert target(as_of=datetime(2025, 11, 9, 1)) == date(2025, 11, 9)
    with pytest.raises(ValueError):
        target("09.11.2025")
