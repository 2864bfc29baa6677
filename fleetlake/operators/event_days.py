"""Which event days the arrival partitions of a table hold, so that a job over event days can skip the others.

One small row per batch and partition, written before the batch's rows: the index may name days that never
came, and never lacks one that did.  A partition that the index does not know, or knows from before the
index began, counts as holding any day.  Rows appended by other means than the jobs here are not in it: add
them with ``record``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import times
from fleetlake.operators import sinks
from fleetlake.registry import EVENT_DAYS, FileType, Lake
from fleetlake.sources.tables import exists, is_streamed, open_table

#: Files that the index of a type may consist of before they are gathered.
INDEX_FILES = 32


def record(lake: Lake, rows: DataFrame, file_type: FileType, batch_id: str) -> None:
    """Adds the days of rows that are about to be appended; they are counted up in every map task."""
    spark, partition = rows.sparkSession, file_type.partition_column
    own = {"batch_id": F.lit(batch_id), "file_type": F.lit(file_type.name)}
    if not exists(spark, f"{lake.event_days}/file_type={file_type.name}"):
        there = [(date.fromisoformat(d),) for d in sinks.folders(spark, lake.raw(file_type.name), partition)]
        if there:
            unknown = {"first_day": F.lit(None).cast("date"), "last_day": F.lit(None).cast("date")}
            sinks.append_event_days(spark.createDataFrame(there, "date date").withColumns(unknown | own), lake.event_days)
    day = times.event_date(rows, file_type.time_column)
    found = rows.groupBy(F.col(partition).alias("date")).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    sinks.append_event_days(found.withColumns(own), lake.event_days)
    sinks.compact_partitions(spark, lake.event_days, EVENT_DAYS, "file_type", [file_type.name], INDEX_FILES)


def partitions_with(spark: SparkSession, lake: Lake, file_type: FileType, first_day: date, last_day: date) -> list[str] | None:
    """The arrival partitions that may hold events of a range of days; None if only the table itself can tell."""
    if is_streamed(spark, lake.raw(file_type.name)):
        return None
    there = sinks.folders(spark, lake.raw(file_type.name), file_type.partition_column)
    index = open_table(spark, lake.event_days, EVENT_DAYS, "file_type").where(F.col("file_type") == file_type.name)
    apart = (F.col("last_day") < F.lit(first_day)) | (F.col("first_day") > F.lit(last_day))
    without = index.groupBy("date").agg(F.bool_and(F.coalesce(apart, F.lit(False))).alias("apart")).where("apart").select("date")
    skipped = {row.date.isoformat() for row in without.collect()}  # a calendar at most
    return [d for d in there if d not in skipped]
