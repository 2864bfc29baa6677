"""One query per operator.  Times come back zone-free in UTC, dates as ``yyyy-MM-dd`` text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import workspace
from fleetlake.functions import times
from fleetlake.operators import files, latest, quality, sinks, unnest
from fleetlake.plans import ingest, summary
from fleetlake.registry import EXTRA, REJECTS, SUMMARY, VEHICLE_EVENTS, VEHICLE_STATUS, Lake
from fleetlake.sources import envelopes, listing, tables
from fleetlake.streaming import ingest as stream_in
from fleetlake.streaming import summary as stream_out
from workload import tables as given

TARGET = date(2024, 1, 16)
AS_OF = datetime(2024, 1, 16, 1, tzinfo=timezone.utc)
LATE_AS_OF = datetime(2024, 1, 17, 6, tzinfo=timezone.utc)
LOADED_UNTIL = "2024-01-15"
BY_ID = ("event_id",)


def _rows_per_date(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("rows"))


def _stored_events(spark: SparkSession, lake: Lake) -> DataFrame:
    return tables.read_table(spark, lake.raw("vehicle_events"), VEHICLE_EVENTS.table)


def _stored_summary(spark: SparkSession, path: str) -> DataFrame:
    return _utc(summary.stored_summary(spark, path).select(*SUMMARY.names), "last_event_time")


def _utc(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, times.utc_reading(df, column))


# --- summaries -------------------------------------------------------------------------------


def daily_summary(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir)
    return summary.daily_summary(events, TARGET, AS_OF, tie_break=BY_ID)


def last_event_per_vehicle_day(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir).select("vehicle_id", "event_time", "event_type", "event_id")
    last = latest.last_per_vehicle_day(latest.with_event_date(events), tie_break=BY_ID)
    return last.select(
        "vehicle_id",
        F.col("day").cast("string").alias("day"),
        F.col("event_time").alias("last_event_time"),
        F.col("event_type").alias("last_event_type"),
        "event_id",
    )


def backfill_daily_summary(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir)
    return summary.backfill(events, date(2024, 1, 5), date(2024, 1, 12), tie_break=BY_ID)


def backfill_with_lookback(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir)
    return summary.backfill(
        events, date(2024, 1, 5), date(2024, 1, 12), lookback_days=2, tie_break=BY_ID
    )


def event_day(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir)
    return latest.with_event_day(events).select("event_id", "day")


def late_window_filter(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir)
    return summary.window_events(events, TARGET, LATE_AS_OF).select("event_id", "event_time")


def event_time_sample(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir)
    return latest.event_time_sample(events, 5, then=BY_ID).select("event_id", "event_time")


def summary_upsert(spark, sf_dir):
    """Summaries of what came on time, then the late arrivals folded in."""
    lake = Lake(workspace.work_dir(spark, "upsert"))
    events = given.vehicle_events(spark, sf_dir)
    on_time = F.col("date") == F.col("event_time").cast("date")
    first = given.as_table(events.where(on_time), VEHICLE_EVENTS)
    sinks.overwrite_days(summary.summarize(first), lake.summary)
    late = given.as_table(events.where(~on_time), VEHICLE_EVENTS)
    summary.upsert(spark, summary.summarize(late), lake.summary)
    return _stored_summary(spark, lake.summary)


def daily_summary_job(spark, sf_dir):
    """The writing job over the stored lake, for one day, read back from the stored summary."""
    events = given.events_lake(spark, sf_dir)
    lake = Lake(events.base, reports=workspace.work_dir(spark, "daily-job"))
    summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    return _stored_summary(spark, lake.summary)


def backfill_job(spark, sf_dir):
    """The writing job over a range of days; a stale row of one of them goes."""
    events = given.events_lake(spark, sf_dir)
    lake = Lake(events.base, reports=workspace.work_dir(spark, "backfill-job"))
    stale = given.vehicle_events(spark, sf_dir).select(
        "vehicle_id", F.lit(None).cast("timestamp").alias("last_event_time"), F.lit("stale").alias("last_event_type"), F.lit("2024-01-06").alias("day")
    )
    sinks.overwrite_days(stale.distinct(), lake.summary)
    summary.run_backfill(spark, lake, date(2024, 1, 5), date(2024, 1, 12))
    return _stored_summary(spark, lake.summary)


def summary_over_streamed_table(spark, sf_dir):
    """The daily job over a table that a stream wrote, with files in it that no commit names."""
    base = workspace.work_dir(spark, "streamed")
    lake = Lake(base)
    path = lake.raw("vehicle_events")
    stream_in.ingest_stream(_tagged_stream(spark, sf_dir), VEHICLE_EVENTS, path, f"{base}/checkpoint").awaitTermination()
    day = F.col("date").cast("string") == "2024-01-15"
    stray = _stored_events(spark, lake).where(day).withColumn("event_type", F.lit("zzz"))
    stray.drop("date").write.mode("append").parquet(f"{path}/date=2024-01-15")
    summary.run_daily_summary(spark, lake, TARGET, AS_OF)
    return _stored_summary(spark, lake.summary)


# --- files -----------------------------------------------------------------------------------


def classify_files(spark, sf_dir):
    names = given.file_names(spark, sf_dir)
    return files.classify(names).select("event_id", F.col("file_name").alias("fn"), "file_type", "match_kind")


def group_files_by_type(spark, sf_dir):
    return files.group_by_type(files.classify(given.file_names(spark, sf_dir)))


def partition_date_from_name(spark, sf_dir):
    names = files.classify(given.file_names(spark, sf_dir), F.lit(given.INGEST_DATE))
    return names.select("event_id", F.col("date").cast("string").alias("date"))


def ingest_new_files_only(spark, sf_dir):
    """Files of a ledger that knows everything named up to a date are left out."""
    names = given.file_names(spark, sf_dir)
    ledger = names.where(F.col("ts").cast("date").cast("string") <= LOADED_UNTIL).select(
        "file_path", F.lit("processed").alias("state")
    )
    rest = files.not_loaded(names, ledger)
    return rest.select("event_id", F.col("file_name").alias("fn"))


def list_incoming_files(spark, sf_dir):
    found = listing.list_incoming(spark, given.landed(spark, sf_dir), recursive=True)
    classified = files.classify(found)
    return classified.groupBy("file_type", F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("files")
    )


# --- envelopes and quality -------------------------------------------------------------------


def unnest_envelope(spark, sf_dir):
    read = envelopes.read_envelope_folder(
        spark, given.landed(spark, sf_dir), VEHICLE_EVENTS, "vehicles_events_*.json", recursive=True
    )
    records = quality.parse_time(unnest.unnest(read, VEHICLE_EVENTS), "event_time")
    return _utc(records, "event_time").select(
        "vehicle_id",
        "event_time",
        "event_source",
        "event_type",
        "event_value",
        F.col("event_extra_data")["note"].alias("note"),
        F.col("event_extra_data")["boot_time"].alias("boot_time"),
        F.col("date").cast("string").alias("date"),
    )


def envelope_root_key_alias(spark, sf_dir):
    """Envelopes under the singular key in odd hours, under the plural one in even hours."""
    events = given.vehicle_events(spark, sf_dir)
    texts = events.withColumn("odd", F.hour("event_time") % 2 == 1).withColumn(
        "event_time", given.iso(F.col("event_time"))
    )
    packed = given.pack(texts, VEHICLE_EVENTS, F.col("event_id"), odd=F.col("odd"))
    content = F.when(F.col("odd"), given.envelope_text("vehicle_events")).otherwise(
        given.envelope_text("vehicles_events")
    )
    read = envelopes.parse_envelopes(
        packed.select(F.lit("vehicles_events_latest.json").alias("file_path"), content.alias("content")),
        VEHICLE_EVENTS,
    )
    used = read.select(
        unnest.root_key_used(VEHICLE_EVENTS).alias("root_key"),
        unnest.root_records(VEHICLE_EVENTS).alias("records"),
    )
    return used.groupBy("root_key").agg(F.sum("records").alias("records"))


def required_columns_check(spark, sf_dir):
    events = given.vehicle_events(spark, sf_dir)
    blanked = events.withColumn("event_source", F.lit(None).cast("string"))
    return quality.required_columns(blanked, VEHICLE_EVENTS.required)


def null_counts(spark, sf_dir):
    events = given.with_gaps(given.vehicle_events(spark, sf_dir))
    return quality.null_counts(events, VEHICLE_EVENTS.required)


def parse_event_time(spark, sf_dir):
    texts = given.event_time_texts(given.vehicle_events(spark, sf_dir)).select("event_id", "event_time")
    return _utc(quality.parse_time(texts, "event_time"), "event_time")


def quarantine_records(spark, sf_dir):
    texts = given.defective_envelopes(spark, sf_dir)
    read = envelopes.parse_envelopes(texts, VEHICLE_EVENTS)
    tagged = ingest.tagged_records(read, VEHICLE_EVENTS, F.lit(given.INGEST_DATE))
    return quality.reason_counts(tagged)


def _ingest_defective(spark, sf_dir, lake, policy, **more):
    return ingest.run_ingest(
        spark,
        lake,
        given.landed_defective(spark, sf_dir),
        policy=policy,
        ingest_date=given.INGEST_DATE,
        recursive=True,
        raise_on_failure=False,
        **more,
    )


def run_counters(spark, sf_dir):
    """A whole ingest of defective files under the quarantine policy, reduced to its counters."""
    lake = Lake(workspace.work_dir(spark, "counters"))
    return _ingest_defective(spark, sf_dir, lake, ingest.QUARANTINE)


def fail_batch_counters(spark, sf_dir):
    """The same under the policy that lets nothing of a bad batch in."""
    lake = Lake(workspace.work_dir(spark, "fail-batch"))
    return _ingest_defective(spark, sf_dir, lake, ingest.FAIL_BATCH)


def fail_batch_any_size(spark, sf_dir):
    """The same with several files to a reader instead of all: the decision is still one."""
    lake = Lake(workspace.work_dir(spark, "fail-batch-chunks"))
    return _ingest_defective(spark, sf_dir, lake, ingest.FAIL_BATCH, files_per_read=15)


def reject_reasons(spark, sf_dir):
    """What the rejects table holds after such an ingest."""
    lake = Lake(workspace.work_dir(spark, "rejects"))
    _ingest_defective(spark, sf_dir, lake, ingest.QUARANTINE)
    return _by_reason(tables.read_table(spark, lake.rejects, REJECTS))


def _by_reason(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason", "detail").agg(F.count("*").alias("rows"))


# --- the lake --------------------------------------------------------------------------------


def append_partitioned_events(spark, sf_dir):
    lake = Lake(workspace.work_dir(spark, "append"))
    events = given.as_table(given.vehicle_events(spark, sf_dir), VEHICLE_EVENTS)
    sinks.append_partitioned(events, lake.raw("vehicle_events"), by_partition=True)
    return _rows_per_date(_stored_events(spark, lake))


def ingest_files(spark, sf_dir):
    """All landed files ingested, then once more to see that nothing is loaded twice."""
    lake = Lake(workspace.work_dir(spark, "ingest"))
    folder = given.landed(spark, sf_dir)
    for _ in range(2):
        ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, recursive=True)
    events = _stored_events(spark, lake)
    statuses = tables.read_table(spark, lake.raw("vehicle_status"), VEHICLE_STATUS.table)
    return (
        _rows_per_date(events)
        .withColumn("file_type", F.lit("vehicle_events"))
        .unionByName(_rows_per_date(statuses).withColumn("file_type", F.lit("vehicle_status")))
    )


def ingest_after_crash(spark, sf_dir):
    """An ingest whose last ledger rows are lost, and a second one: nothing twice, nothing missing."""
    lake = Lake(workspace.work_dir(spark, "crash"))
    folder = f"{given.landed(spark, sf_dir)}/events"
    ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, recursive=True)
    started = ingest.ledger_table(spark, lake).withColumns({"reason": F.col("state"), "state": F.lit(ingest.STARTED)})
    crashed = Lake(lake.base, control=workspace.work_dir(spark, "crash-control"))
    sinks.append_open_batch(started, crashed.open_batches)
    ingest.run_ingest(spark, crashed, folder, ingest_date=given.INGEST_DATE, recursive=True)
    return _rows_per_date(_stored_events(spark, crashed))


def ingest_redelivered_name(spark, sf_dir):
    """Every event file delivered again under its name, with other bytes: loaded both times."""
    lake, folder = Lake(workspace.work_dir(spark, "again")), workspace.work_dir(spark, "again-landed")
    envelopes_ = given.event_envelopes(spark, sf_dir)
    for content in (F.col("content"), F.concat(F.col("content"), F.lit(" "))):
        given.land(envelopes_.withColumn("content", content), folder)
        ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, recursive=True)
    return _rows_per_date(_stored_events(spark, lake))


def list_incoming_incremental(spark, sf_dir):
    """What a second run over dated folders has to load, after a first one that set its mark."""
    lake, folder = Lake(workspace.work_dir(spark, "marked")), workspace.work_dir(spark, "marked-landed")
    stamp = F.regexp_extract("file_path", r"(\d{8})\d{6}", 1)
    every = given.event_envelopes(spark, sf_dir).withColumn("stamp", stamp)
    today = times.utc_now().strftime("%Y-%m-%d")
    path = F.concat_ws("/", F.lit(today), "file_path")
    until = LOADED_UNTIL.replace("-", "")
    options = {"incremental": True, "dated": "%Y-%m-%d", "recursive": True}
    given.land(every.where(F.col("stamp") <= until).withColumn("file_path", path), folder)
    ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, **options)
    given.land(every.where(F.col("stamp") > until).withColumn("file_path", path), folder)
    found = ingest.new_files(spark, lake, ingest.list_new(spark, lake, folder, **options), F.lit(given.INGEST_DATE))
    return found.groupBy("file_type", F.col("date").cast("string").alias("date")).agg(F.count("*").alias("files"))


def envelope_encodings(spark, sf_dir):
    """The event files in five encodings."""
    lake, folder = Lake(workspace.work_dir(spark, "encoded")), workspace.work_dir(spark, "encoded-landed")
    given.land(given.encoded(given.event_envelopes(spark, sf_dir)), folder)
    ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, recursive=True)
    return _rows_per_date(_stored_events(spark, lake))


def records_accounted_for(spark, sf_dir):
    """Loaded records and refused ones of defective files; refused files by number."""
    lake = Lake(workspace.work_dir(spark, "accounts"))
    _ingest_defective(spark, sf_dir, lake, ingest.QUARANTINE)
    loaded = _stored_events(spark, lake).agg(F.count("*").alias("records_loaded"))
    of_record = F.col("detail").isNotNull()
    refused = tables.read_table(spark, lake.rejects, REJECTS).agg(
        F.count_if(of_record).alias("records_refused"), F.count_if(~of_record).alias("files_refused")
    )
    return loaded.join(refused)


def unknown_file_rejects(spark, sf_dir):
    """Every event file under a name of no supported type: a reject and a ledger row each."""
    lake, folder = Lake(workspace.work_dir(spark, "unknown")), workspace.work_dir(spark, "unknown-landed")
    named = F.replace("file_path", F.lit("vehicles_events_"), F.lit("trips_"))
    given.land(given.event_envelopes(spark, sf_dir).withColumn("file_path", named), folder)
    ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, recursive=True, raise_on_failure=False)
    rejects = tables.read_table(spark, lake.rejects, REJECTS)
    known = ingest.ledger_table(spark, lake).select("file_path", "state")
    return rejects.join(known, "file_path").groupBy("reason", "state").agg(F.count("*").alias("files"))


def no_events_reasons(spark, sf_dir):
    """Why the daily job found nothing: no raw table, no partitions of those days, none in its window."""
    lake = given.events_lake(spark, sf_dir)
    cases = {
        "no table": (Lake(workspace.work_dir(spark, "absent")), date(2024, 1, 16)),
        "before all": (lake, date(2023, 1, 16)),
        "after all": (lake, date(2024, 2, 3)),
    }
    rows = []
    for case, (where, day) in cases.items():
        result = summary.run_daily_summary(spark, Lake(where.base, reports=workspace.work_dir(spark, "none")), day, AS_OF)
        rows.append((case, result.status, result.reason, len(result.sample)))
    return spark.createDataFrame(rows, "case string, status string, reason string, sample long")


def schema_drift(spark, sf_dir):
    """New fields of every event file, by type and arrival day, as the ingest reports them; the values are in the lake."""
    lake, folder = Lake(workspace.work_dir(spark, "drift")), workspace.work_dir(spark, "drift-landed")
    given.land(given.drifted_envelopes(spark, sf_dir), folder)
    ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, recursive=True)
    kept = _stored_events(spark, lake).select("date", F.explode(EXTRA).alias("field", "value"))
    kept = kept.groupBy("date", "field").agg(F.count("*").alias("kept"))
    found = ingest.schema_drift(spark, lake).join(kept, ["date", "field"])
    return found.select(F.col("date").cast("string").alias("date"), "field", "type", "records", "kept")


def replay_rejects(spark, sf_dir):
    """Refused records loaded after a rule was found for events without a source, twice over: what is in the lake."""
    lake = Lake(workspace.work_dir(spark, "replay"))
    _ingest_defective(spark, sf_dir, lake, ingest.QUARANTINE)
    for _ in range(2):
        ingest.replay_rejects(spark, lake, VEHICLE_EVENTS, lambda r: r.withColumn("event_source", F.coalesce("event_source", F.lit("unknown"))))
    events = _stored_events(spark, lake).withColumn("known", F.col("event_source") != "unknown")
    return events.groupBy(F.col("date").cast("string").alias("date"), "known").agg(F.count("*").alias("rows"))


def view_before_first_load(spark, sf_dir):
    """Views made over a lake that holds nothing yet show what is ingested afterwards."""
    lake = Lake(workspace.work_dir(spark, "view-first"))
    databases = ("early_raw", "early_reports")
    tables.create_views(spark, lake, databases)
    folder = f"{given.landed(spark, sf_dir)}/events"
    ingest.run_ingest(spark, lake, folder, ingest_date=given.INGEST_DATE, recursive=True)
    return _rows_per_date(spark.table("early_raw.vehicle_events"))


def scan_date_partitions(spark, sf_dir):
    lake = given.events_lake(spark, sf_dir)
    days = ["2024-01-15", "2024-01-16", "2024-03-01"]
    return _rows_per_date(
        tables.scan_partitions(spark, lake.raw("vehicle_events"), VEHICLE_EVENTS.table, days)
    )


def vehicle_events_view(spark, sf_dir):
    given.viewed_lake(spark, sf_dir)
    view = _utc(spark.table("raw_data.vehicle_events"), "event_time")
    return view.select(
        "vehicle_id",
        "event_time",
        "event_type",
        "event_source",
        "event_value",
        "event_extra_data.note",
        "event_extra_data.boot_time",
        F.col("date").cast("string").alias("date"),
    )


def vehicle_status_view(spark, sf_dir):
    given.viewed_lake(spark, sf_dir)
    view = _utc(spark.table("raw_data.vehicle_status"), "report_time")
    return view.withColumn("date", F.col("date").cast("string"))


def daily_summary_for_day(spark, sf_dir):
    given.viewed_lake(spark, sf_dir)
    rows = spark.sql("SELECT * FROM reports.daily_summary WHERE day = '2024-01-15'")
    return _utc(rows, "last_event_time")


def _listing_with_rows(spark: SparkSession, raw: str, reports: str) -> DataFrame:
    counts = spark.sql(
        f"""
        SELECT '{raw}' AS table_schema, 'vehicle_events' AS table_name, count(*) AS rows
        FROM {raw}.vehicle_events
        UNION ALL SELECT '{raw}', 'vehicle_status', count(*) FROM {raw}.vehicle_status
        UNION ALL SELECT '{reports}', 'daily_summary', count(*) FROM {reports}.daily_summary
        """
    )
    return tables.catalog_listing(spark, (raw, reports)).join(counts, ["table_schema", "table_name"])


def catalog_listing(spark, sf_dir):
    """The catalog's views with the rows behind each."""
    given.viewed_lake(spark, sf_dir)
    return _listing_with_rows(spark, *tables.DATABASES)


def table_definitions(spark, sf_dir):
    """The same lake, all summary changes folded in, defined as external tables in databases of their own."""
    databases = ("raw_tables", "report_tables")
    lake = given.viewed_lake(spark, sf_dir)
    summary.compact_summary(spark, lake.summary)
    tables.create_tables(spark, lake, databases)
    for name in ("raw_tables.vehicle_events", "raw_tables.vehicle_status", "report_tables.daily_summary"):
        spark.catalog.recoverPartitions(name)
    return _listing_with_rows(spark, *databases)


# --- streams ---------------------------------------------------------------------------------


def _tagged_stream(spark, sf_dir):
    return stream_in.tagged_stream(
        spark, f"{given.landed(spark, sf_dir)}/events/*", VEHICLE_EVENTS, "vehicles_events_*.json"
    )


def stream_ingest(spark, sf_dir):
    """The landed event files as a stream, run twice over the same checkpoint."""
    folder = workspace.work_dir(spark, "stream-ingest")
    for _ in range(2):
        tagged = _tagged_stream(spark, sf_dir)
        with workspace.few_listing_tasks(spark):
            stream_in.ingest_stream(tagged, VEHICLE_EVENTS, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    return _rows_per_date(tables.read_table(spark, f"{folder}/events", VEHICLE_EVENTS.table))


def stream_rejects(spark, sf_dir):
    """The refused records of defective files, found by a stream."""
    folder = workspace.work_dir(spark, "stream-rejects")
    tagged = stream_in.tagged_stream(spark, f"{given.landed_defective(spark, sf_dir)}/*", VEHICLE_EVENTS)
    stream_in.reject_stream(tagged, VEHICLE_EVENTS, f"{folder}/rejects", f"{folder}/checkpoint").awaitTermination()
    return _by_reason(spark.read.parquet(f"{folder}/rejects"))


#: Files come in the order of their making, which is not that of their dates.
ANY_ORDER = "90 days"


def stream_daily_summary(spark, sf_dir):
    """Three micro-batches; some days are folded in, the others read as base and changes."""
    folder = workspace.work_dir(spark, "stream-summary")
    source = f"{given.landed(spark, sf_dir)}/events/*"
    third = -(-listing.list_incoming(spark, source).count() // 3)
    tagged = stream_in.tagged_stream(spark, source, VEHICLE_EVENTS, "vehicles_events_*.json", max_files_per_trigger=third)
    changes = stream_out.last_per_vehicle_day_stream(quality.good(tagged, VEHICLE_EVENTS), ANY_ORDER)
    with workspace.few_listing_tasks(spark):
        stream_out.summary_stream(changes, f"{folder}/summary", f"{folder}/checkpoint").awaitTermination()
    summary.compact_summary(spark, f"{folder}/summary", before=date(2024, 1, 16))
    return _stored_summary(spark, f"{folder}/summary")


def stream_tie_break(spark, sf_dir):
    """Many equal times, settled by source, then type, across micro-batches."""
    folder = workspace.work_dir(spark, "stream-ties")
    given.land(given.coarse_envelopes(spark, sf_dir), f"{folder}/landed/events")
    source = f"{folder}/landed/events/*"
    third = -(-listing.list_incoming(spark, source).count() // 3)
    tagged = stream_in.tagged_stream(spark, source, VEHICLE_EVENTS, max_files_per_trigger=third)
    by = ("event_source", "event_type")
    changes = stream_out.last_per_vehicle_day_stream(quality.good(tagged, VEHICLE_EVENTS), ANY_ORDER, by)
    with workspace.few_listing_tasks(spark):
        stream_out.summary_stream(changes, f"{folder}/summary", f"{folder}/checkpoint").awaitTermination()
    return _stored_summary(spark, f"{folder}/summary")


def stream_ingest_mixed_folder(spark, sf_dir):
    """A stream over a folder of both types takes its own files by their names."""
    folder = workspace.work_dir(spark, "stream-mixed")
    tagged = stream_in.tagged_stream(spark, f"{given.landed(spark, sf_dir)}/*/*", VEHICLE_EVENTS)
    stream_in.ingest_stream(tagged, VEHICLE_EVENTS, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    return _rows_per_date(tables.read_table(spark, f"{folder}/events", VEHICLE_EVENTS.table))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        daily_summary,
        last_event_per_vehicle_day,
        backfill_daily_summary,
        backfill_with_lookback,
        event_day,
        late_window_filter,
        scan_date_partitions,
        classify_files,
        group_files_by_type,
        partition_date_from_name,
        list_incoming_files,
        unnest_envelope,
        envelope_root_key_alias,
        required_columns_check,
        null_counts,
        parse_event_time,
        quarantine_records,
        reject_reasons,
        append_partitioned_events,
        ingest_files,
        ingest_new_files_only,
        summary_upsert,
        daily_summary_job,
        event_time_sample,
        run_counters,
        fail_batch_counters,
        fail_batch_any_size,
        ingest_after_crash,
        view_before_first_load,
        backfill_job,
        summary_over_streamed_table,
        vehicle_events_view,
        vehicle_status_view,
        daily_summary_for_day,
        catalog_listing,
        table_definitions,
        stream_ingest,
        stream_rejects,
        stream_daily_summary,
        ingest_redelivered_name,
        list_incoming_incremental,
        envelope_encodings,
        records_accounted_for,
        unknown_file_rejects,
        no_events_reasons,
        schema_drift,
        replay_rejects,
        stream_tie_break,
        stream_ingest_mixed_folder,
    )
}
