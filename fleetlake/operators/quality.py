"""Validation.  Each check is an expression or one aggregate: a single pass, however many fields.

``null_counts``, ``required_columns`` and ``reason_counts`` are for users who look at a table; the jobs
take the same facts on the pass that they make anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import times
from fleetlake.registry import BATCH_ID, FUTURE_DAYS, FileType

OK = "ok"

# Reject reasons that say the data broke the schema, not the file or its name.
SCHEMA_REASONS = ("missing_root_key", "null_required", "bad_timestamp", "bad_record", "future_timestamp")
# Reasons that are about one record; all others are about its whole file.
RECORD_REASONS = ("null_required", "bad_timestamp", "bad_record", "future_timestamp")


class SchemaMismatch(ValueError):
    """A table lacks columns that a job needs."""


def parse_time(records: DataFrame, column: str) -> DataFrame:
    """Replaces text by an instant; unreadable text becomes null and never an error."""
    return records.withColumn(column, times.parse_instant(F.col(column)))


def null_counts(records: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row, one count per required field."""
    return records.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])


def required_columns(records: DataFrame, required: Sequence[str]) -> DataFrame:
    """``column, present`` per required column.

    Under a fixed read schema a column that is missing from the data is null throughout, so it
    counts as present once any row has a value.  A column the table lacks is absent.
    """
    known = [c for c in required if c in records.columns]
    counts = records.agg(*[F.count(c).alias(c) for c in known]) if known else records.agg(F.count("*"))
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), (F.col(c) > 0 if c in known else F.lit(False)).alias("present"))
            for c in required
        ]
    )
    return counts.select(F.inline(pairs))


def require_columns(table: DataFrame, required: Sequence[str]) -> None:
    """Raises before any job runs if the table's schema lacks a column."""
    missing = [c for c in required if c not in table.columns]
    if missing:
        raise SchemaMismatch(f"missing required columns: {missing}")


def first_null(required: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])


def tag(records: DataFrame, file_type: FileType) -> DataFrame:
    """Parses the time and adds ``reason`` (``ok`` or why not) and ``detail``; drops nothing.

    A time more than ``FUTURE_DAYS`` after the file's arrival date is refused: one such event would
    close every open day of a stream.  The raw text is kept for rejects only.
    """
    time = file_type.time_column
    facts = records.withColumns(
        {"parsed": times.parse_instant(F.col(time)), "missing": first_null(file_type.required)}
    )
    problem, missing, unreadable = F.col("file_problem"), F.col("missing"), F.col("parsed").isNull()
    day = times.instant_to_utc(F.col("parsed")).cast("date")
    future = day > F.date_add(F.col(file_type.partition_column), FUTURE_DAYS)
    reason = (
        F.when(problem.isNotNull(), problem)
        .when(missing.isNotNull(), "null_required")
        .when(unreadable, "bad_timestamp")
        .when(future, "future_timestamp")
        .otherwise(OK)
    )
    detail = F.when(problem.isNull(), F.coalesce(missing, F.when(unreadable | future, F.col(time))))
    return facts.withColumns(
        {"reason": reason, "detail": detail, "record": F.when(reason != OK, F.col("raw")), time: F.col("parsed")}
    ).drop("file_problem", "raw", "parsed", "missing")


def good(tagged: DataFrame, file_type: FileType, batch_id: str | None = None) -> DataFrame:
    """The good records as rows of the lake's table, stamped with their batch."""
    stamped = tagged.where(F.col("reason") == OK).withColumn(BATCH_ID, F.lit(batch_id).cast("string"))
    return stamped.select(*file_type.table.names)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason") != OK)


def reason_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("reason").agg(F.count("*").alias("rows"))
