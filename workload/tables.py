"""The given tables read as vehicle telemetry, and the files and lake derived from them.

Every row of a table is kept.  The ``%`` expressions assign a property to each row (how late it
arrives, how its file is named); none of them selects rows.
"""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import workspace
from fleetlake.functions import times
from fleetlake.operators import sinks
from fleetlake.plans import ingest, summary
from fleetlake.registry import ANY_RECORD, BATCH_ID, EXTRA, SOURCE_FILE, VEHICLE_EVENTS, VEHICLE_STATUS, FileType, Lake
from fleetlake.sources.tables import create_views, read_table

INGEST_DATE = date(2024, 1, 31)
RECORDS_PER_FILE = 2000
SECONDS_PER_DAY = 86400
#: Files that a Python task holds at a time when it writes them.
LAND_BATCH = 16
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Files that arrived on these days are broken in these ways.
TRUNCATED_DAY = "2024-01-10"
OTHER_KEY_DAY = "2024-01-11"
BAD_STAMP_DAY = "2024-01-12"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events and statuses ---------------------------------------------------------------------


def vehicle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as vehicle events; every tenth comes a day late, every 97th three days late."""
    days_late = (
        F.when(F.col("event_id") % 10 == 0, 1).when(F.col("event_id") % 97 == 0, 3).otherwise(0)
    )
    source = F.element_at(
        F.array(F.lit("mobile"), F.lit("device"), F.lit("sensor")),
        (F.col("event_id") % 3).cast("int") + 1,
    )
    boot_time = F.when(source == "device", F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("V"), "user_id").alias("vehicle_id"),
        F.col("ts").alias("event_time"),
        source.alias("event_source"),
        "event_type",
        F.col("value").cast("string").alias("event_value"),
        F.create_map(F.lit("note"), "event_type", F.lit("boot_time"), boot_time).alias("event_extra_data"),
        F.date_add(F.col("ts").cast("date"), days_late).alias("date"),
        "value",
    )


def vehicle_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as vehicle statuses, arriving on the day they report on."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("status_id"),
        F.concat(F.lit("V"), "o_custkey").alias("vehicle_id"),
        F.col("o_orderdate").alias("report_time"),
        F.col("o_orderpriority").alias("status_source"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("date"),
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incoming file name per event, in the eight spellings that occur."""
    digits = F.regexp_replace(F.col("ts").cast("string"), "[^0-9]", "")
    stamp = F.substring(digits, 1, 14)
    style = F.col("event_id") % 8
    name = (
        F.when(style == 0, F.concat(F.lit("vehicles_events_"), stamp, F.lit(".json")))
        .when(style == 1, F.concat(F.lit("vehicle_events_"), stamp, F.lit(".json")))
        .when(style == 2, F.concat(F.lit("vehicles_status_"), stamp, F.lit(".json")))
        .when(style == 3, F.concat(F.lit("vehicle_status_"), stamp, F.lit(".json")))
        .when(style == 4, F.concat(F.lit("VEHICLES_EVENTS_"), stamp, F.lit(".JSON")))
        .when(style == 5, F.lit("backup_vehicle_events_final.json"))
        .when(style == 6, F.lit("vehicles_events_latest.json"))
        .otherwise(F.concat(F.lit("trips_"), stamp, F.lit(".json")))
    )
    path = F.concat(F.lit("incoming/"), F.col("event_id").cast("string"), F.lit("/"), name)
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", name.alias("file_name"), path.alias("file_path")
    )


def iso(wall: Column) -> Column:
    """A zone-free time as ISO text ending in Z."""
    return F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


# --- with defects ----------------------------------------------------------------------------


def event_time_texts(events: DataFrame) -> DataFrame:
    """Event times as text: some with an offset, some unreadable."""
    offset = F.concat(
        F.replace((F.col("event_time") + F.expr("INTERVAL 2 HOURS")).cast("string"), F.lit(" "), F.lit("T")),
        F.lit("+02:00"),
    )
    text = (
        F.when(F.col("value") < 1, "not a time")
        .when(F.col("event_type") == "view", offset)
        .otherwise(iso(F.col("event_time")))
    )
    return events.withColumn("event_time", text)


def with_gaps(events: DataFrame) -> DataFrame:
    """Some vehicle ids and sources are missing."""
    return events.withColumns(
        {
            "vehicle_id": F.when((F.col("value") < 1) | (F.col("value") >= 3), F.col("vehicle_id")),
            "event_source": F.when(F.col("value") <= 200, F.col("event_source")),
        }
    )


# --- envelopes -------------------------------------------------------------------------------


def pack(records: DataFrame, file_type: FileType, number: Column, **keys: Column) -> DataFrame:
    """Records packed into envelopes: ``<keys>, number, records, content_key``.

    ``number`` numbers the records through, so a group never exceeds ``RECORDS_PER_FILE``.
    """
    chunk = F.floor(number / RECORDS_PER_FILE)
    record = F.struct(*file_type.record.names)
    return records.groupBy(*[c.alias(k) for k, c in keys.items()], chunk.alias("chunk")).agg(
        F.collect_list(record).alias("records")
    )


def envelope_text(root_key: str) -> Column:
    return F.to_json(F.struct(F.col("records").alias(root_key)))


def arrival_path(prefix: str, day: Column) -> Column:
    """A path whose file name follows the convention and is unique per (day, chunk)."""
    second = F.col("chunk") % SECONDS_PER_DAY
    clock = [F.floor(second / 3600), F.floor(second / 60) % 60, second % 60]
    stamp = F.concat(
        F.replace(day.cast("string"), F.lit("-"), F.lit("")),
        *[F.lpad(c.cast("string"), 2, "0") for c in clock],
    )
    folder = F.floor(F.col("chunk") / SECONDS_PER_DAY).cast("string")
    return F.concat(folder, F.lit(f"/{prefix}_"), stamp, F.lit(".json"))


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_path, content`` of every event, in files by arrival date."""
    events = vehicle_events(spark, sf_dir).withColumn("event_time", iso(F.col("event_time")))
    packed = pack(events, VEHICLE_EVENTS, F.col("event_id"), date=F.col("date"))
    return packed.select(
        arrival_path("vehicles_events", F.col("date")).alias("file_path"),
        envelope_text("vehicles_events").alias("content"),
    )


def encoded(envelopes: DataFrame) -> DataFrame:
    """The same files in five encodings, with byte order marks and without, by the day they arrived on."""
    text, day = F.col("content"), F.substring(F.regexp_extract("file_path", r"(\d{14})", 1), 7, 2).cast("int")
    marked = lambda mark, kind: F.concat(F.lit(mark), F.encode(text, kind))
    content = (
        F.when(day % 5 == 0, F.encode(text, "UTF-8"))
        .when(day % 5 == 1, marked(b"\xef\xbb\xbf", "UTF-8"))
        .when(day % 5 == 2, marked(b"\xff\xfe", "UTF-16LE"))
        .when(day % 5 == 3, marked(b"\xfe\xff", "UTF-16BE"))
        .otherwise(F.encode(text, "UTF-16LE"))
    )
    return envelopes.withColumn("content", content)


def coarse_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, its time cut to the hour, so that many of a vehicle are equally late."""
    events = vehicle_events(spark, sf_dir).withColumn("event_time", iso(F.date_trunc("hour", "event_time")))
    packed = pack(events, VEHICLE_EVENTS, F.col("event_id"), date=F.col("date"))
    return packed.select(
        arrival_path("vehicles_events", F.col("date")).alias("file_path"),
        envelope_text("vehicles_events").alias("content"),
    )


def drifted_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with fields that no schema names, some on some events only."""
    events = vehicle_events(spark, sf_dir).withColumn("event_time", iso(F.col("event_time")))
    new = {
        "speed": F.when(F.col("event_type") == "view", F.lit(1.5)),
        "gear": F.when(F.col("event_source") == "device", F.lit(3)),
        "position": F.when(F.col("event_source") == "sensor", F.struct(F.lit(1).alias("x"))),
        "driver": F.lit("d"),
    }
    record = F.struct(*VEHICLE_EVENTS.record.names, *new)
    chunk = F.floor(F.col("event_id") / RECORDS_PER_FILE)
    packed = events.withColumns(new).groupBy("date", chunk.alias("chunk")).agg(F.collect_list(record).alias("records"))
    return packed.select(
        arrival_path("vehicles_events", F.col("date")).alias("file_path"),
        envelope_text("vehicles_events").alias("content"),
    )


def status_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every status, in files that arrive on the day of their newest report."""
    statuses = vehicle_status(spark, sf_dir).withColumn("report_time", iso(F.col("report_time")))
    packed = pack(statuses, VEHICLE_STATUS, F.col("status_id"))
    newest = F.to_date(F.substring(F.array_max("records.report_time"), 1, 10))
    return packed.select(
        arrival_path("vehicles_status", newest).alias("file_path"),
        envelope_text("vehicle_status").alias("content"),
    )


def defective_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with missing fields and unreadable times, and three days of broken files."""
    events = with_gaps(event_time_texts(vehicle_events(spark, sf_dir)))
    packed = pack(events, VEHICLE_EVENTS, F.col("event_id"), date=F.col("date"))
    day = F.col("date").cast("string")
    whole = envelope_text("vehicles_events")
    content = (
        F.when(day == TRUNCATED_DAY, F.expr("left(whole, length(whole) - 2)"))
        .when(day == OTHER_KEY_DAY, envelope_text("trips"))
        .otherwise(F.col("whole"))
    )
    path = arrival_path("vehicles_events", F.col("date"))
    month_99 = F.regexp_replace(path, "_202401", "_202499")
    return packed.withColumn("whole", whole).select(
        F.when(day == BAD_STAMP_DAY, month_99).otherwise(path).alias("file_path"), content.alias("content")
    )


def land(envelopes: DataFrame, folder: str) -> None:
    """Writes each envelope, text or bytes, as a file of its own name.  Writing one twice gives the same file."""
    root = "file:///" + folder[5:].lstrip("/") if folder.startswith("file:") else folder

    def write(batches):
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path, content in zip(batch["file_path"].to_pylist(), batch["content"]):
                filesystem.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(f"{base}/{path}") as out:
                    out.write(content.as_buffer())
            yield batch.select(["file_path"])

    landed_paths = envelopes.select("file_path", "content").mapInArrow(write, "file_path string")
    with workspace.configured(envelopes.sparkSession, _ARROW_ROWS, str(LAND_BATCH)):
        landed_paths.write.format("noop").mode("overwrite").save()


# --- what later queries start from -----------------------------------------------------------


@cache
def landed(spark: SparkSession, sf_dir: str) -> str:
    """A folder with all events and statuses as envelope files."""
    folder = workspace.work_dir(spark, "landed")
    land(event_envelopes(spark, sf_dir), f"{folder}/events")
    land(status_envelopes(spark, sf_dir), f"{folder}/status")
    return folder


@cache
def landed_defective(spark: SparkSession, sf_dir: str) -> str:
    folder = workspace.work_dir(spark, "landed-defective")
    land(defective_envelopes(spark, sf_dir), folder)
    return folder


def as_table(records: DataFrame, file_type: FileType) -> DataFrame:
    """Records under the lake's schema: times as instants, and a file of origin."""
    instants = records.withColumn(
        file_type.time_column, times.utc_to_instant(F.col(file_type.time_column))
    )
    given = {SOURCE_FILE: F.concat(F.lit("given/"), "vehicle_id"), BATCH_ID: F.lit("given"), EXTRA: F.lit(None).cast(ANY_RECORD)}
    return instants.withColumns(given).select(*file_type.table.names)


@cache
def events_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake holding all events by arrival date."""
    lake = Lake(workspace.work_dir(spark, "lake"))
    events = as_table(vehicle_events(spark, sf_dir), VEHICLE_EVENTS)
    sinks.append_partitioned(events, lake.raw("vehicle_events"), by_partition=True)
    return lake


@cache
def viewed_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake ingested from the landed files, events and statuses, with summaries and views."""
    lake = Lake(workspace.work_dir(spark, "viewed"))
    ingest.run_ingest(spark, lake, landed(spark, sf_dir), ingest_date=INGEST_DATE, recursive=True)
    stored = read_table(spark, lake.raw("vehicle_events"), VEHICLE_EVENTS.table)
    first = stored.where(F.col("date") < F.lit(date(2024, 1, 16)))
    sinks.overwrite_days(summary.summarize(first), lake.summary)
    summary.upsert(spark, summary.summarize(stored.where(F.col("date") >= F.lit(date(2024, 1, 16)))), lake.summary)
    create_views(spark, lake)
    return lake
