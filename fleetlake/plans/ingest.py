"""Ingest: land envelope files in the lake, once each, bad ones set aside with a reason.

State lives in tables, not in folders.  The *ledger* holds one row per file that was dealt with, by a
day that the file keeps; *rejects* holds every record or file that was refused; *open batches* holds
the files of batches that are being loaded, and is empty between runs.  A *mark* per incoming folder says
up to which modification time it was listed.  Nothing is moved.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlake.functions import times
from fleetlake.functions.names import base_name, decoded
from fleetlake.operators import counters, drift, event_days, files, quality, sinks
from fleetlake.operators.unnest import fields_of, unnest
from fleetlake.registry import (
    ANY_RECORD,
    BATCH_ID,
    DRIFT,
    EXTRA,
    FILE_DAY,
    FILE_TYPES,
    LEDGER,
    MARKS,
    REJECTS,
    REPLAYS,
    SOURCE_FILE,
    UNKNOWN_TYPE,
    FileType,
    Lake,
)
from fleetlake.sources.envelopes import parse_envelopes, read_envelopes
from fleetlake.sources.listing import dated_folders, list_everything
from fleetlake.sources.tables import NO_VALUE, open_table, scan_partitions

FAIL_BATCH = "fail_batch"
QUARANTINE = "quarantine"
STARTED, REPLAYED = "started", "replayed"
#: Paths given to one reader; nothing else depends on it.
FILES_PER_READ = 20_000
#: Readers that one job reads with; a batch of more takes several jobs, one after the other.
READERS_PER_JOB = 16
#: How far behind the mark an incremental run still looks, for clocks that differ and slow uploads.
OVERLAP = timedelta(days=1)
#: Files that a day of the ledger may consist of before they are gathered.
LEDGER_FILES = 16


class BatchRejected(RuntimeError):
    """At least one file of the run failed; the lake holds what the policy let through."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(f"ingest finished with failed files: {counts}")
        self.counts = counts


def ledger_table(spark: SparkSession, lake: Lake) -> DataFrame:
    """A row may be there twice after a crash in a compaction."""
    return open_table(spark, lake.ledger, LEDGER, FILE_DAY)


def ledger_of_days(spark: SparkSession, lake: Lake, days: Iterable[date]) -> DataFrame:
    """The ledger's partitions of some days, and that of no day.

    Only their folders are listed, so that neither the listing nor the join grows with the ledger's age.
    """
    return scan_partitions(spark, lake.ledger, LEDGER, [NO_VALUE, *sorted(d.isoformat() for d in days)], FILE_DAY)


def open_batch_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    return open_table(spark, lake.open_batches, LEDGER, "batch_id")


def rejects_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return open_table(spark, lake.rejects, REJECTS, "file_type")


def tagged_records(
    envelopes: DataFrame, file_type: FileType, ingest_date: Column | None = None
) -> DataFrame:
    """Envelopes to records with ``reason``: the whole transformation, shared with the stream."""
    return quality.tag(unnest(envelopes, file_type, ingest_date), file_type)


def reject_rows(tagged: DataFrame, file_type: str, batch_id: str | None) -> DataFrame:
    return quality.rejected(tagged).select(
        F.lit(batch_id).cast("string").alias("batch_id"),
        F.col(SOURCE_FILE).alias("file_path"),
        "reason",
        "detail",
        "record",
        F.current_timestamp().alias("rejected_at"),
        F.uuid().alias("reject_id"),
        "date",
        F.lit(file_type).alias("file_type"),
    )


def _file_counts(listed: DataFrame, tagged: DataFrame) -> DataFrame:
    """Good and bad rows of every listed file, also of those without records, and why the first bad one is."""
    # By reason first: numbers are added up in a hash table, where the least text of all records would have them sorted.
    per_reason = tagged.groupBy(F.col(SOURCE_FILE).alias("file_path"), "reason").agg(F.count("*").alias("n"))
    bad = F.col("reason") != quality.OK
    counts = per_reason.groupBy("file_path").agg(
        F.sum(F.when(~bad, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("bad"),
        F.min(F.when(bad, F.col("reason"))).alias("first_reason"),
    )
    return listed.join(counts, "file_path", "left").fillna(0, ["good", "bad"])


def _ledger_rows(counts: DataFrame, batch_id: str, loaded: bool) -> DataFrame:
    """What becomes of each file.  A good file of a failed batch has the reason ``batch_failed``."""
    if loaded:
        nothing_good = (F.col("bad") > 0) & (F.col("good") == 0)
        state, rows, reason = F.when(nothing_good, "failed").otherwise("processed"), F.col("good"), F.col("first_reason")
    else:
        state, rows, reason = F.lit("failed"), F.lit(0), F.coalesce("first_reason", F.lit("batch_failed"))
    return counts.select(
        "file_path",
        state.alias("state"),
        rows.cast("long").alias("rows"),
        F.lit(batch_id).alias("batch_id"),
        F.current_timestamp().alias("recorded_at"),
        "length",
        "modified_at",
        "date",
        reason.alias("reason"),
        "file_type",
        FILE_DAY,
    )


def _started(ledger_rows: DataFrame) -> DataFrame:
    """The intent to load: the same rows before it happens, with what is to become of each file as reason."""
    return ledger_rows.withColumns({"reason": F.col("state"), "state": F.lit(STARTED)})


def _write_rejects(lake: Lake, rejects: DataFrame) -> dict[str, int]:
    seen = Observation()
    broke_schema = F.col("reason").isin(*quality.SCHEMA_REASONS)
    counted = rejects.observe(
        seen, F.count(F.lit(1)).alias("rows_rejected"), F.count_if(broke_schema).alias("schema_errors")
    )
    sinks.append_rejects(counted, lake.rejects)
    return seen.get


def _write_ledger(lake: Lake, ledger: DataFrame) -> dict[str, int]:
    seen = Observation()
    counted = ledger.observe(
        seen,
        F.count_if(F.col("state") == "processed").alias("processed"),
        F.count_if(F.col("state") == "failed").alias("failed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_loaded"),
    )
    sinks.append_ledger(counted, lake.ledger)
    return seen.get


def _tagged_parts(
    spark: SparkSession, listed: DataFrame, file_type: FileType, ingest_date: Column | None, files_per_read: int
) -> Iterator[DataFrame]:
    """The tagged records of all the files, those of some readers at a time; at least one part, with the empty files.

    Every task reports on all readers of its job, so what the driver gets would grow with the square of their number.
    """
    paths = [row.path for row in listed.where("length > 0").select("path").collect()]
    step = files_per_read * READERS_PER_JOB
    for k in range(0, max(len(paths), 1), step):
        if paths:
            envelopes = read_envelopes(spark, paths[k : k + step], file_type, files_per_read)
        else:
            envelopes = parse_envelopes(spark.createDataFrame([], "file_path string, content string"), file_type)
        tagged = tagged_records(envelopes, file_type, ingest_date)
        yield tagged if k else tagged.unionByName(_empty_files(listed, tagged.schema))


def _empty_files(listed: DataFrame, shape: StructType) -> DataFrame:
    """A tagged row for each file of zero bytes, which no reader shows."""
    known = {SOURCE_FILE: F.col("file_path"), "reason": F.lit("empty_file"), "date": F.col("date")}
    return listed.where("length = 0").select(*(known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in shape))


def load_batch(
    spark: SparkSession,
    lake: Lake,
    listed: DataFrame,
    file_type: FileType,
    batch_id: str,
    policy: str = FAIL_BATCH,
    ingest_date: Column | None = None,
    files_per_read: int = FILES_PER_READ,
) -> Row:
    """Loads the listed files (``file_path, path, length, modified_at, date, file_type, file_day``), parsing each once.

    The parsed records are staged, and counted from there.  The counts settle the policy for all
    files at once, before the lake changes: under ``fail_batch`` one bad record keeps the whole batch
    out; under ``quarantine`` only what is bad stays out.  The batch is open before the load starts and
    until the ledger has its files, so that a crash on the way can be settled.
    """
    parts = _tagged_parts(spark, listed, file_type, ingest_date, files_per_read)
    tagged, facts = sinks.stage_parts_counted(parts, "records", unknown=F.count(EXTRA))
    counts, seen = sinks.stage_counted(_file_counts(listed, tagged), "file-counts", bad=F.sum("bad"))
    clean = not seen["bad"]
    loaded = clean or policy == QUARANTINE
    refused = {"rows_rejected": 0, "schema_errors": 0}
    if not clean:
        refused = _write_rejects(lake, reject_rows(tagged, file_type.name, batch_id))
    rows = _ledger_rows(counts, batch_id, loaded)
    if loaded and facts["unknown"]:
        report_drift(lake, tagged.where(F.col("reason") == quality.OK), file_type.name, batch_id)
    if loaded:
        sinks.append_open_batch(_started(rows), lake.open_batches)
        good = quality.good(tagged, file_type, batch_id)
        event_days.record(lake, good, file_type, batch_id)
        sinks.append_partitioned(good, lake.raw(file_type.name), file_type.partition_column)
    result = Row(batch_id=batch_id, file_type=file_type.name, **_write_ledger(lake, rows), **refused)
    sinks.drop_partitions(spark, lake.open_batches, "batch_id", [batch_id])
    return result


def report_drift(lake: Lake, records: DataFrame, file_type: str, batch_id: str) -> None:
    """Records which fields a batch brought that its schema does not name.  The values are kept with the rows."""
    found = drift.unknown_fields(records).withColumns({"batch_id": F.lit(batch_id), "file_type": F.lit(file_type)})
    sinks.append_drift(found, lake.drift)


def schema_drift(spark: SparkSession, lake: Lake) -> DataFrame:
    """New fields of all batches that were loaded, by type, arrival day and field."""
    reported = open_table(spark, lake.drift, DRIFT, "file_type")
    loaded = ledger_table(spark, lake).where("state = 'processed'").select("batch_id").distinct()
    kept = reported.join(loaded, "batch_id", "left_semi")
    return kept.groupBy("file_type", "date", "field", "type").agg(F.sum("records").alias("records"))


def refuse_unknown(lake: Lake, listed: DataFrame, batch_id: str) -> Row:
    """Files of no supported type: a reject and a ledger row each."""
    refused = listed.select(
        F.lit(batch_id).alias("batch_id"),
        "file_path",
        F.lit("unknown_type").alias("reason"),
        F.col("file_name").alias("detail"),
        F.lit(None).cast("string").alias("record"),
        F.current_timestamp().alias("rejected_at"),
        F.uuid().alias("reject_id"),
        "date",
        "file_type",
    )
    counts = listed.withColumns({"good": F.lit(0), "bad": F.lit(1), "first_reason": F.lit("unknown_type")})
    rejects = _write_rejects(lake, refused)
    return Row(batch_id=batch_id, file_type=UNKNOWN_TYPE, **_write_ledger(lake, _ledger_rows(counts, batch_id, True)), **rejects)


def _folder_key(folder: str) -> str:
    return hashlib.sha256(folder.rstrip("/").encode()).hexdigest()[:16]


def listing_mark(spark: SparkSession, lake: Lake, folder: str) -> Row | None:
    """``mark`` and ``depth`` of the last run over ``folder`` that ended, if there was one."""
    marks = open_table(spark, lake.marks, MARKS, "folder_key").where(F.col("folder_key") == _folder_key(folder))
    return marks.orderBy(F.desc("recorded_at")).first()


@dataclass(frozen=True)
class Listing:
    """Files by name, length and time, the days the ledger keeps them under, and where and when they were last made."""

    files: DataFrame
    days: list[date]
    newest: datetime | None
    depth: int


def list_new(
    spark: SparkSession,
    lake: Lake,
    folder: str,
    retry_failed: bool = False,
    recursive: bool = False,
    modified_after: datetime | None = None,
    incremental: bool = False,
    dated: str | None = None,
    overlap: timedelta = OVERLAP,
) -> Listing:
    """What a run has to look at, listed once, with ``file_day``.

    ``incremental`` goes back to ``overlap`` before the folder's mark; what was seen before is for the
    ledger to settle.  ``dated`` is the date format of folders below ``folder`` that files are delivered to, in
    UTC: then only those from that day on are listed.  Without a mark, and with ``retry_failed``, all is listed.
    """
    mark = listing_mark(spark, lake, folder) if incremental and not retry_failed else None
    since = None if modified_after is None else times.as_utc(modified_after)
    folders, depth = folder, 0
    if mark is not None:
        depth = mark.depth
        behind = datetime.fromtimestamp(mark.mark.timestamp(), timezone.utc) - overlap
        since = behind if since is None else max(since, behind)
        if dated is not None:
            folders = dated_folders(folder, dated, behind.date(), times.utc_now().date() + timedelta(days=1))
            depth = max(0, depth - dated.count("/") - 1)
    elif dated is not None:
        recursive = True  # all dated folders, whichever there are
    facts: dict = {}

    def staged(shown: DataFrame) -> tuple[DataFrame, int]:
        kept = shown.withColumns({"hidden": F.lit(False), FILE_DAY: files.file_day()})
        table, seen = sinks.stage_counted(kept, "listing", days=F.collect_set(FILE_DAY), newest=F.max("modified_at"))
        facts.update(seen)
        return table, seen["rows"]

    listed, others, deep = list_everything(spark, folders, recursive=recursive, modified_after=since, depth=depth, staged=staged)
    days, newest = {*facts["days"]}, [facts["newest"]]
    if others is not None:
        others, seen = sinks.stage_counted(
            others.withColumn(FILE_DAY, files.file_day()), "listing-others", days=F.collect_set(FILE_DAY), newest=F.max("modified_at")
        )
        listed = listed.unionByName(others)
        days, newest = days | {*seen["days"]}, [*newest, seen["newest"]]
    if mark is not None and dated is not None:
        deep += dated.count("/") + 1
    return Listing(listed, sorted(days), max((m for m in newest if m is not None), default=None), deep)


def new_files(
    spark: SparkSession,
    lake: Lake,
    listing: Listing,
    ingest_date: Column | None = None,
    retry_failed: bool = False,
) -> DataFrame:
    """Listed files that the ledger does not know, with type and arrival date.

    Hidden files are of no supported type, whatever the rest of their names.  Of the ledger only the days
    are read that listed files belong to.
    """
    known = ledger_of_days(spark, lake, listing.days)
    found = files.classify(files.not_loaded(listing.files, known, retry_failed=retry_failed), ingest_date)
    return found.withColumn("file_type", F.when(F.col("hidden"), UNKNOWN_TYPE).otherwise(F.col("file_type"))).drop("hidden")


def set_mark(spark: SparkSession, lake: Lake, folder: str, listing: Listing, started: datetime) -> None:
    """Records that everything listed was dealt with.  A mark never moves back, nor beyond the run's start."""
    before = listing_mark(spark, lake, folder)
    marks = [m.timestamp() for m in (listing.newest, before and before.mark) if m is not None]
    if marks:
        at = datetime.fromtimestamp(min(max(marks), started.timestamp()), timezone.utc)
        row = (folder, at, max(listing.depth, before.depth if before else 0), times.utc_now(), _folder_key(folder))
        sinks.write_mark(spark.createDataFrame([row], MARKS), lake.marks)


def run_ingest(
    spark: SparkSession,
    lake: Lake,
    folder: str,
    policy: str = FAIL_BATCH,
    ingest_date: date | None = None,
    files_per_read: int = FILES_PER_READ,
    retry_failed: bool = False,
    recursive: bool = False,
    modified_after: datetime | None = None,
    raise_on_failure: bool = True,
    incremental: bool = False,
    dated: str | None = None,
) -> DataFrame:
    """Loads every new file under ``folder``; returns one row of counters for the run.

    The new files of one type are one batch, whatever their number: ``files_per_read`` only says how
    many paths one reader gets.  What an earlier run left half done is settled first.  Raises
    ``BatchRejected`` at the end if any file failed.  ``incremental`` and ``dated``: see ``list_new``.
    """
    if policy not in (FAIL_BATCH, QUARANTINE):
        raise ValueError(f"unknown policy {policy!r}")
    run_id, started = uuid.uuid4().hex, times.utc_now()
    today = F.lit(ingest_date) if ingest_date is not None else times.utc_today()
    settle_open_batches(spark, lake)
    # Listed once: a file that arrives from here on belongs to the next run.
    listing = list_new(spark, lake, folder, retry_failed, recursive, modified_after, incremental, dated)
    found, facts = sinks.stage_counted(
        new_files(spark, lake, listing, today, retry_failed), "incoming", types=F.collect_set("file_type"), days=F.collect_set(FILE_DAY)
    )
    results = []
    for name in sorted(facts["types"]):
        batch_id = f"{run_id}-{name}"
        listed = found.where(F.col("file_type") == name)
        if name == UNKNOWN_TYPE:
            results.append(refuse_unknown(lake, listed, batch_id))
        else:
            results.append(load_batch(spark, lake, listed, FILE_TYPES[name], batch_id, policy, today, files_per_read))
    if results:
        compact_ledger(spark, lake, facts["days"])
    if incremental and modified_after is None:
        set_mark(spark, lake, folder, listing, started)
    counts = counters.run_counters(spark.createDataFrame(results, counters.BATCH_RESULTS))
    totals = counts.first().asDict()
    if raise_on_failure and totals["total_failed"]:
        raise BatchRejected(totals)
    return counts


def compact_ledger(spark: SparkSession, lake: Lake, days: Sequence[date], max_files: int = LEDGER_FILES) -> list[str]:
    """Gathers the files of days of the ledger that many runs have added to; returns those days."""
    return sinks.compact_partitions(spark, lake.ledger, LEDGER, FILE_DAY, sorted(d.isoformat() for d in days), max_files)


def settle_open_batches(spark: SparkSession, lake: Lake) -> list[str]:
    """Settles batches that a crash interrupted between their start and their last ledger rows.

    A batch whose rows are all in the lake is recorded as it was meant to be.  Of any other the rows
    that got there are taken out again, and its files stay new.  Returns the batches settled.  Only the open
    batches are read, and what ledger and lake have of their days.
    """
    begun = open_batch_rows(spark, lake)
    facts = begun.groupBy("batch_id", "file_type").agg(
        F.sum("rows").alias("rows"), F.collect_set("date").alias("dates"), F.collect_set(FILE_DAY).alias("days")
    )
    settled = []
    for batch in facts.collect():  # a crash leaves one or two; a batch has as many dates as the calendar
        own_rows = begun.where(F.col("batch_id") == batch.batch_id)
        ended = ledger_of_days(spark, lake, batch.days).where(F.col("batch_id") == batch.batch_id)
        if ended.isEmpty():
            file_type = FILE_TYPES[batch.file_type]
            path, column = lake.raw(file_type.name), file_type.partition_column
            table = open_table(spark, path, file_type.table, column).where(F.col(column).isin([F.lit(d) for d in batch.dates]))
            own = F.col(BATCH_ID).eqNullSafe(F.lit(batch.batch_id))
            arrived = table.where(own).count()
            if arrived == batch.rows:
                state, reason = F.col("reason"), F.lit(None).cast("string")
            else:
                state, reason = F.lit("abandoned"), F.lit("interrupted")
                if arrived:
                    sinks.replace_partitions(table, ~own, path, column, [d.isoformat() for d in batch.dates])
            sinks.append_ledger(own_rows.withColumns({"state": state, "reason": reason, "recorded_at": F.current_timestamp()}), lake.ledger)
            settled.append(batch.batch_id)
        sinks.drop_partitions(spark, lake.open_batches, "batch_id", [batch.batch_id])
    return settled


# --- replay ---------------------------------------------------------------------------------


def pending_rejects(spark: SparkSession, lake: Lake, file_type: FileType) -> DataFrame:
    """Refused records that no replay has loaded yet.  Whole files are for ``retry_failed``: they are where they were."""
    ended = ledger_table(spark, lake).where(F.col("state") == REPLAYED).select("batch_id").distinct()
    replays = open_table(spark, lake.replays, REPLAYS, "file_type").where(F.col("outcome") == quality.OK)
    loaded = replays.join(ended, "batch_id", "left_semi").select("reject_id")
    own = rejects_table(spark, lake).where((F.col("file_type") == file_type.name) & F.col("reason").isin(*quality.RECORD_REASONS))
    return own.join(loaded, "reject_id", "left_anti")


def replay_rejects(
    spark: SparkSession,
    lake: Lake,
    file_type: FileType,
    fix: Callable[[DataFrame], DataFrame] = lambda records: records,
) -> Row:
    """Sends refused records through today's rules again and loads those that pass; returns ``loaded`` and ``refused``.

    ``fix`` may change the records, times still text, before they are judged.  Every reject stays; the
    replays table has what became of it, by its id.  A record is loaded once: the batch is open while it loads,
    like any other, and only a batch that the ledger calls replayed counts.
    """
    settle_open_batches(spark, lake)
    batch_id = f"{uuid.uuid4().hex}-replay-{file_type.name}"
    arrived = F.coalesce("date", files.stamp_day(base_name(decoded(F.col("file_path")))), times.instant_to_utc(F.col("rejected_at")).cast("date"))
    rejects = pending_rejects(spark, lake, file_type).select(
        F.col("file_path").alias(SOURCE_FILE),
        "reject_id",
        arrived.alias(file_type.partition_column),
        F.lit(None).cast("string").alias("file_problem"),
        F.lit(None).cast(ANY_RECORD).alias("given"),
        F.col("record").alias("text"),
    )
    records = fields_of(rejects, file_type, [SOURCE_FILE, "reject_id", file_type.partition_column, "file_problem"])
    tagged, seen = sinks.stage_counted(quality.tag(fix(records), file_type), "replayed", good=F.count_if(F.col("reason") == quality.OK))
    if seen["rows"]:
        good = tagged.where(F.col("reason") == quality.OK)
        outcome = tagged.select("reject_id", F.lit(batch_id).alias("batch_id"), F.col("reason").alias("outcome"), "detail", F.lit(file_type.name).alias("file_type"))
        sinks.append_replays(outcome, lake.replays)
        per_file = good.groupBy(F.col(SOURCE_FILE).alias("file_path"), F.col(file_type.partition_column).alias("date")).agg(F.count("*").alias("rows"))
        none = {"length": F.lit(None).cast("long"), "modified_at": F.lit(None).cast("timestamp"), "file_type": F.lit(file_type.name)}
        rows = per_file.withColumns(
            none | {FILE_DAY: files.stamp_day(base_name(decoded(F.col("file_path")))), "state": F.lit(STARTED), "reason": F.lit(REPLAYED), "batch_id": F.lit(batch_id), "recorded_at": F.current_timestamp()}
        )
        rows = sinks.stage(rows.select(*LEDGER.names), "replayed-files")
        if seen["good"]:
            sinks.append_open_batch(rows, lake.open_batches)
            rows_ = quality.good(good, file_type, batch_id)
            event_days.record(lake, rows_, file_type, batch_id)
            sinks.append_partitioned(rows_, lake.raw(file_type.name), file_type.partition_column)
            sinks.append_ledger(rows.withColumns({"state": F.col("reason"), "reason": F.lit(None).cast("string")}), lake.ledger)
            sinks.drop_partitions(spark, lake.open_batches, "batch_id", [batch_id])
    return Row(batch_id=batch_id, loaded=seen["good"], refused=seen["rows"] - seen["good"])


def past_batches(spark: SparkSession, lake: Lake) -> DataFrame:
    """The results of all batches that ended, from ledger and rejects."""
    ended = ledger_table(spark, lake).where(F.col("state").isin("processed", "failed")).distinct()
    return counters.batch_results(ended, rejects_table(spark, lake))


def recover_ledger(
    spark: SparkSession, lake: Lake, file_type: FileType, arrival_days: Sequence[date]
) -> DataFrame:
    """Ledger rows for files whose rows are in the lake but which the ledger does not know.

    ``run_ingest`` settles its own crashes; this is for a lake whose ledger was lost.  Call it with the
    arrival days concerned; it returns what it added.
    """
    table = open_table(spark, lake.raw(file_type.name), file_type.table, file_type.partition_column)
    loaded = table.where(F.col(file_type.partition_column).isin([F.lit(d) for d in arrival_days]))
    per_file = loaded.groupBy(F.col(SOURCE_FILE).alias("file_path")).agg(F.count("*").alias("rows"))
    per_file = per_file.withColumn(FILE_DAY, files.stamp_day(base_name(decoded(F.col("file_path")))))
    missing = files.not_loaded(per_file, ledger_table(spark, lake), retry_failed=True)
    rows = sinks.stage(
        missing.select(
            "file_path",
            F.lit("processed").alias("state"),
            "rows",
            F.lit("recovered").alias("batch_id"),
            F.current_timestamp().alias("recorded_at"),
            F.lit(None).cast("long").alias("length"),
            F.lit(None).cast("timestamp").alias("modified_at"),
            F.lit(None).cast("date").alias("date"),
            F.lit(None).cast("string").alias("reason"),
            F.lit(file_type.name).alias("file_type"),
            FILE_DAY,
        ),
        "recovered",
    )
    sinks.append_ledger(rows, lake.ledger)
    return rows
