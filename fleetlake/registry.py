"""What the lake holds: file types, record and table schemas, and where each table lives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DateType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: these must be exactly so for files and results to match. ---------------
EVENT_ROOT_KEYS = ("vehicles_events", "vehicle_events")
STATUS_ROOT_KEYS = ("vehicles_status", "vehicle_status")
EVENT_REQUIRED = ("vehicle_id", "event_time", "event_source", "event_type")
STATUS_REQUIRED = ("vehicle_id", "report_time", "status_source", "status")
SUMMARY_REQUIRED = ("vehicle_id", "event_time", "event_type")
UNKNOWN_TYPE = "unknown"
LATENESS_HOURS = 48
LOOKBACK_DAYS = 2

EVENTS_VIEW_ORDER = (
    "vehicle_id",
    "event_time",
    "event_type",
    "event_source",
    "event_value",
    "event_extra_data",
    "date",
)
STATUS_VIEW_ORDER = ("vehicle_id", "report_time", "status", "status_source", "date")
SUMMARY_VIEW_ORDER = ("vehicle_id", "day", "last_event_time", "last_event_type")
# The columns of the extra data that the events view offers as typed fields.
EXTRA_DATA_FIELDS = (
    ("note", "string"),
    ("boot_time", "int"),
    ("emergency_call", "boolean"),
    ("severity", "string"),
)
# -----------------------------------------------------------------------------------------

#: An event may be dated this many days after its file's arrival date at most.
FUTURE_DAYS = 1

CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
BATCH_ID = "_batch_id"
#: The fields of a record that no schema names, null without any.
EXTRA = "_extra_fields"
ANY_RECORD = MapType(StringType(), StringType())


@dataclass(frozen=True)
class FileType:
    """One kind of incoming file: its envelope keys, its record and the table it feeds."""

    name: str
    root_keys: tuple[str, ...]
    required: tuple[str, ...]
    optional: tuple[StructField, ...]
    time_column: str
    view_order: tuple[str, ...]
    partition_column: str = "date"

    @property
    def record(self) -> StructType:
        """A record as it stands in the JSON, times still text, nothing assumed non-null."""
        return StructType([StructField(c, StringType()) for c in self.required] + list(self.optional))

    @property
    def envelope(self) -> StructType:
        """The whole JSON object: every accepted root key side by side, its records still text,
        so that an odd record can't spoil the others."""
        keys = [StructField(k, ArrayType(StringType())) for k in self.root_keys]
        return StructType(keys + [StructField(CORRUPT, StringType())])

    @property
    def clean_envelope(self) -> StructType:
        """A list of envelopes whose records are all objects; of whatever fields, their values as text."""
        keys = StructType([StructField(k, ArrayType(ANY_RECORD)) for k in self.root_keys])
        return StructType([StructField("envelopes", ArrayType(keys)), StructField(CORRUPT, StringType())])

    @property
    def table(self) -> StructType:
        """The stored table: times are instants, the file of origin and the batch are kept."""
        fields = [
            StructField(f.name, TimestampType() if f.name == self.time_column else f.dataType)
            for f in self.record
        ]
        return StructType(
            fields
            + [StructField(EXTRA, ANY_RECORD), StructField(SOURCE_FILE, StringType()), StructField(BATCH_ID, StringType())]
            + [StructField(self.partition_column, DateType())]
        )


VEHICLE_EVENTS = FileType(
    name="vehicle_events",
    root_keys=EVENT_ROOT_KEYS,
    required=EVENT_REQUIRED,
    optional=(
        StructField("event_value", StringType()),
        StructField("event_extra_data", MapType(StringType(), StringType())),
    ),
    time_column="event_time",
    view_order=EVENTS_VIEW_ORDER,
)

VEHICLE_STATUS = FileType(
    name="vehicle_status",
    root_keys=STATUS_ROOT_KEYS,
    required=STATUS_REQUIRED,
    optional=(),
    time_column="report_time",
    view_order=STATUS_VIEW_ORDER,
)

# Order matters: the fallback match on file names takes the first type that fits.
FILE_TYPES: dict[str, FileType] = {t.name: t for t in (VEHICLE_EVENTS, VEHICLE_STATUS)}

SUMMARY = StructType(
    [
        StructField("vehicle_id", StringType()),
        StructField("last_event_time", TimestampType()),
        StructField("last_event_type", StringType()),
        StructField("day", StringType()),
    ]
)
#: What is stored besides: the tie-break values of the row, by which later arrivals are ranked.
TIE = "_tie"
STORED_SUMMARY = StructType([*SUMMARY.fields, StructField(TIE, ArrayType(StringType()))])

REJECTS = StructType(
    [
        StructField("batch_id", StringType()),
        StructField("file_path", StringType()),
        StructField("reason", StringType()),
        StructField("detail", StringType()),
        StructField("record", StringType()),
        StructField("rejected_at", TimestampType()),
        StructField("reject_id", StringType()),
        StructField("date", DateType()),
        StructField("file_type", StringType()),
    ]
)

REPLAYS = StructType(
    [
        StructField("reject_id", StringType()),
        StructField("batch_id", StringType()),
        StructField("outcome", StringType()),
        StructField("detail", StringType()),
        StructField("file_type", StringType()),
    ]
)

#: Which event days a batch brought to an arrival partition; unknown for rows from before the index.
EVENT_DAYS = StructType(
    [
        StructField("date", DateType()),
        StructField("first_day", DateType()),
        StructField("last_day", DateType()),
        StructField("batch_id", StringType()),
        StructField("file_type", StringType()),
    ]
)

DRIFT = StructType(
    [
        StructField("batch_id", StringType()),
        StructField("date", DateType()),
        StructField("field", StringType()),
        StructField("type", StringType()),
        StructField("records", LongType()),
        StructField("file_type", StringType()),
    ]
)

LEDGER = StructType(
    [
        StructField("file_path", StringType()),
        StructField("state", StringType()),
        StructField("rows", LongType()),
        StructField("batch_id", StringType()),
        StructField("recorded_at", TimestampType()),
        StructField("length", LongType()),
        StructField("modified_at", TimestampType()),
        StructField("date", DateType()),
        StructField("reason", StringType()),
        StructField("file_type", StringType()),
        StructField("file_day", DateType()),
    ]
)
#: The ledger's partition column: a day that a file keeps, whenever it is listed.
FILE_DAY = "file_day"

MARKS = StructType(
    [
        StructField("folder", StringType()),
        StructField("mark", TimestampType()),
        StructField("depth", LongType()),
        StructField("recorded_at", TimestampType()),
        StructField("folder_key", StringType()),
    ]
)


@dataclass(frozen=True)
class Lake:
    """Table locations under a base URI (any scheme Spark can read).

    Reports and the control tables live under the same base unless ``reports`` or ``control`` name another.
    """

    base: str
    reports: str | None = None
    control: str | None = None

    def raw(self, file_type: str) -> str:
        return _under(self.base, "raw_data", file_type)

    @property
    def summary(self) -> str:
        return _under(self.reports or self.base, "reports", "daily_summary")

    @property
    def summary_changes(self) -> str:
        return changes_of(self.summary)

    @property
    def rejects(self) -> str:
        return _under(self.control or self.base, "control", "rejects")

    @property
    def ledger(self) -> str:
        return _under(self.control or self.base, "control", "ledger")

    @property
    def event_days(self) -> str:
        return _under(self.control or self.base, "control", "event_days")

    @property
    def drift(self) -> str:
        return _under(self.control or self.base, "control", "schema_drift")

    @property
    def replays(self) -> str:
        return _under(self.control or self.base, "control", "replays")

    @property
    def open_batches(self) -> str:
        return _under(self.control or self.base, "control", "open_batches")

    @property
    def marks(self) -> str:
        return _under(self.control or self.base, "control", "listing_marks")


def changes_of(path: str) -> str:
    """Where the changes to a stored summary are that were not folded into it yet."""
    return f"{path.rstrip('/')}_changes"


def _under(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])
