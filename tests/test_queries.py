"""Every registered query against its SQL, in session zones that are not UTC."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.conftest import SF_DIR
from workload import tables as given
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


def check(spark, duck, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = contract.queries()[name](spark, SF_DIR)
        columns = sorted(df.columns)
        ours = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    theirs = sorted(
        (tuple(row[names.index(c)] for c in columns) for row in answer.fetchall()), key=repr
    )
    assert ours == theirs
    assert ours


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    check(spark, duck, name, "America/New_York")


@pytest.mark.parametrize(
    "name",
    [
        "daily_summary",
        "daily_summary_job",
        "backfill_with_lookback",
        "event_day",
        "late_window_filter",
        "parse_event_time",
        "summary_upsert",
        "unnest_envelope",
    ],
)
def test_matches_sql_east_of_utc(spark, duck, name):
    check(spark, duck, name, "Asia/Tokyo")


def test_files_are_landed_few_at_a_time(spark, tmp_path, monkeypatch):
    """However many files a task writes, its Python holds few of them."""
    held = spark.sparkContext.accumulator(0, _Most())

    def counted(frame, write, schema):
        def watched(batches):
            return write(held.add(batch.num_rows) or batch for batch in batches)

        return map_in_arrow(frame, watched, schema)

    kind = type(spark.range(1))
    map_in_arrow = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", counted)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = spark.range(100, numPartitions=1).selectExpr("concat('a/', id, '.json') AS file_path", "concat('é', id) AS content")
    given.land(files, str(tmp_path / "text"))
    given.land(files.withColumn("content", F.encode("content", "UTF-16LE")), f"file:{tmp_path}/bytes")
    assert held.value == given.LAND_BATCH
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    for folder, encoding in (("text", "utf-8"), ("bytes", "utf-16le")):
        assert {p.name: p.read_bytes() for p in (tmp_path / folder / "a").iterdir()} == {f"{n}.json": f"é{n}".encode(encoding) for n in range(100)}


class _Most(AccumulatorParam):
    def zero(self, value):
        return value

    def addInPlace(self, one, other):
        return max(one, other)


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["vehicle_id", "last_event_time", "last_event_type", "day"]
