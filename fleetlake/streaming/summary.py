"""The daily summary kept up to date by a stream.

State holds one row per vehicle and open day.  A day stays open until the newest event time of
earlier micro-batches is 48 hours past its end, then its state is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from fleetlake.functions import times
from fleetlake.operators.latest import TIE_BREAK
from fleetlake.plans.summary import tie_values, upsert
from fleetlake.registry import LATENESS_HOURS, TIE


def last_per_vehicle_day_stream(
    events: DataFrame,
    lateness: str = f"{LATENESS_HOURS} hours",
    tie_break: Sequence[str] = TIE_BREAK,
) -> DataFrame:
    """Summary rows of a stream of events, with their tie-break values.

    Day windows start at the epoch, hence at UTC midnight in every session zone.  Each task
    combines its rows per key before the shuffle, so no vehicle is too busy.
    """
    rank = F.struct("event_time", *tie_break)
    last = (
        events.withWatermark("event_time", lateness)
        .groupBy("vehicle_id", F.window("event_time", "1 day"))
        .agg(F.max_by(F.struct("event_time", "event_type", tie_values(events, tie_break).alias(TIE)), rank).alias("last"))
    )
    day = times.instant_to_utc(F.col("window.start")).cast("date").cast("string")
    return last.select(
        "vehicle_id",
        F.col("last.event_time").alias("last_event_time"),
        F.col("last.event_type").alias("last_event_type"),
        day.alias("day"),
        F.col(f"last.{TIE}").alias(TIE),
    )


def summary_stream(summary: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Adds each micro-batch's changed rows to the changes of the stored summary.

    A micro-batch holds only vehicles that moved, and writes nothing else.  Readers take the latest row, so
    nothing changes when a micro-batch runs twice.  ``compact_summary`` folds in the days that are closed.
    """

    def publish(rows: DataFrame, _batch_id: int) -> None:
        upsert(rows.sparkSession, rows, path)

    return (
        summary.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
