"""Ingest as a stream: each new file is read once per checkpoint and its rows land exactly once.

A table written by this file sink carries a log of committed files, and Spark reads only those.
Do not let the batch job append to the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from fleetlake.functions import names
from fleetlake.operators import quality
from fleetlake.plans.ingest import reject_rows, tagged_records
from fleetlake.registry import REJECTS, UNKNOWN_TYPE, FileType
from fleetlake.sources.envelopes import ANY_JSON, stream_envelopes


def tagged_stream(
    spark: SparkSession,
    folder: str,
    file_type: FileType,
    pattern: str = ANY_JSON,
    ingest_date: Column | None = None,
    max_files_per_trigger: int | None = None,
    refuse_unknown: bool = False,
) -> DataFrame:
    """Records of the files that are of ``file_type`` by their names, as in the batch.

    Files of another supported type are left to that type's stream.  With ``refuse_unknown``, for one
    of the streams over a folder, files of no supported type come as a row with ``unknown_type`` each.
    """
    envelopes = stream_envelopes(spark, folder, file_type, pattern, max_files_per_trigger)
    kind = F.coalesce(names.strict_type(F.col("file_name")), names.contained_type(F.col("file_name")), F.lit(UNKNOWN_TYPE))
    wanted = [file_type.name, *([UNKNOWN_TYPE] if refuse_unknown else [])]
    return tagged_records(envelopes.withColumn("kind", kind).where(F.col("kind").isin(wanted)), file_type, ingest_date)


def _append(df: DataFrame, path: str, checkpoint: str, partition: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(partition)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(tagged: DataFrame, file_type: FileType, path: str, checkpoint: str) -> StreamingQuery:
    """Good records to the table, everything that is there now, then stop."""
    return _append(quality.good(tagged, file_type), path, checkpoint, file_type.partition_column)


def reject_stream(tagged: DataFrame, file_type: FileType, path: str, checkpoint: str) -> StreamingQuery:
    """Refused records and files with their reason, as a query of its own, in the layout of the batch's rejects."""
    return _append(reject_rows(tagged, file_type.name, None).select(*REJECTS.names), path, checkpoint, "file_type")
