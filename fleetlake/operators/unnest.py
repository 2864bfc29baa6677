"""From envelopes to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from fleetlake.functions import names, times
from fleetlake.registry import ANY_RECORD, CORRUPT, EXTRA, SOURCE_FILE, UNKNOWN_TYPE, FileType
from fleetlake.sources.envelopes import SHOWN


def _by_key(columns: list[Column], element: str) -> Column:
    """All arrays one after the other; null if there is none."""
    every = F.concat(*[F.coalesce(c, F.array().cast(f"array<{element}>")) for c in columns])
    return F.when(F.coalesce(*columns).isNotNull(), every)


def clean_records(file_type: FileType) -> Column:
    """The records of an envelope in which all are objects, under all keys that it uses."""
    return _by_key([F.col("clean")[k] for k in file_type.root_keys], ANY_RECORD.simpleString())


def text_records(file_type: FileType) -> Column:
    """The records of any other envelope, as JSON text."""
    return _by_key([F.col(k) for k in file_type.root_keys], "string")


def root_records(file_type: FileType) -> Column:
    """How many records an envelope has under all accepted keys; null without any key."""
    size = lambda c: F.when(c.isNotNull(), F.size(c))
    return F.coalesce(size(clean_records(file_type)), size(text_records(file_type)))


def root_key_used(file_type: FileType) -> Column:
    return F.coalesce(*[F.when(F.coalesce(F.col("clean")[k].isNotNull(), F.lit(False)) | F.col(k).isNotNull(), F.lit(k)) for k in file_type.root_keys])


def file_problem(file_type: FileType) -> Column:
    """Why a whole file cannot be loaded, or null."""
    return (
        F.when(F.col("kind") == UNKNOWN_TYPE, "unknown_type")
        .when(F.col(CORRUPT).isNotNull(), "corrupt_json")
        .when(root_records(file_type).isNull(), "missing_root_key")
        .when(~names.stamp_is_valid(F.col("stamp")), "bad_stamp")
    )


def unnest(envelopes: DataFrame, file_type: FileType, ingest_date: Column | None = None) -> DataFrame:
    """One row per record, times still text, with the arrival date and the file of origin.

    A file that cannot be loaded yields a single row whose ``file_problem`` says why, a record that
    is no object of the declared kind one with ``bad_record``.  An empty array yields no row.  ``raw`` has
    the text; a record of a file in which all are objects is written out from its fields.
    Name and date are worked out once per file, before the records fan out.
    """
    today = times.utc_today() if ingest_date is None else ingest_date
    if "kind" not in envelopes.columns:
        envelopes = envelopes.withColumn("kind", F.lit(file_type.name))
    date, named = file_type.partition_column, envelopes.withColumn("stamp", names.stamp_of(F.col("file_name")))
    per_file = named.withColumn("file_problem", file_problem(file_type)).select(
        F.col("file_path").alias(SOURCE_FILE),
        names.partition_date(F.col("stamp"), today).alias(date),
        "file_problem",
        F.when(F.col("file_problem").isNull(), clean_records(file_type)).alias("records"),
        F.when(F.col("file_problem").isNull(), text_records(file_type)).otherwise(F.array(F.left("content", F.lit(SHOWN)))).alias("texts"),
    )
    # A file has either records or texts; outer, since what an inner one infers would parse everything again.
    kept = [SOURCE_FILE, date, "file_problem"]
    rows = per_file.select(*kept, "texts", F.posexplode_outer("records").alias("n", "given"))
    rows = rows.select(*kept, "n", "given", F.posexplode_outer("texts").alias("m", "text")).where("n IS NOT NULL OR m IS NOT NULL")
    return fields_of(rows, file_type, kept)


def fields_of(rows: DataFrame, file_type: FileType, kept: Sequence[str]) -> DataFrame:
    """Records as declared, from ``given`` (field names and texts) or else ``text`` (JSON).

    Takes ``file_problem`` along: null, or ``bad_record`` for what is no object or has a declared object that is
    none.  Fields that no schema names are kept in ``_extra_fields``.
    """
    text, given, record = F.col("text"), F.col("given"), F.col("record")
    parsed = F.from_json(F.when(F.col("file_problem").isNull(), text), ANY_RECORD, {"mode": "PERMISSIVE"})
    rows = rows.withColumn("record", F.coalesce(given, parsed))
    objects = {f.name: F.from_json(record[f.name], f.dataType, {"mode": "PERMISSIVE"}) for f in file_type.record if isinstance(f.dataType, MapType)}
    rows = rows.withColumns({f"_{name}": parsed for name, parsed in objects.items()})
    odd = text.isNotNull() & (record.isNull() | F.startswith(F.ltrim(text), F.lit("[")))
    for name in objects:
        odd = odd | (F.coalesce(record[name].isNotNull(), F.lit(False)) & F.col(f"_{name}").isNull())
    extra = F.map_filter(record, lambda field, _: ~field.isin(file_type.record.names))
    return rows.select(
        *(c for c in kept if c != "file_problem"),
        F.coalesce("file_problem", F.when(odd, "bad_record")).alias("file_problem"),
        F.coalesce(text, F.to_json("given")).alias("raw"),
        *((F.col(f"_{c}") if c in objects else record[c]).alias(c) for c in file_type.record.names),
        F.when(F.size(extra) > 0, extra).alias(EXTRA),
    )
