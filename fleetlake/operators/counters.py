"""Run counters, derived from what was recorded rather than counted along the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.operators.quality import SCHEMA_REASONS


BATCH_RESULTS = (
    "batch_id string, file_type string, processed long, failed long, "
    "rows_loaded long, rows_rejected long, schema_errors long"
)


def batch_results(ledger: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row per batch: files by outcome, rows loaded, rows rejected and why."""
    loaded = ledger.groupBy("batch_id", "file_type").agg(
        F.count_if(F.col("state") == "processed").alias("processed"),
        F.count_if(F.col("state") == "failed").alias("failed"),
        F.sum("rows").alias("rows_loaded"),
    )
    refused = rejects.groupBy("batch_id", "file_type").agg(
        F.count("*").alias("rows_rejected"),
        F.count_if(F.col("reason").isin(*SCHEMA_REASONS)).alias("schema_errors"),
    )
    both = loaded.join(refused, ["batch_id", "file_type"], "left")
    return both.fillna(0, ["rows_loaded", "rows_rejected", "schema_errors"])


def run_counters(results: DataFrame) -> DataFrame:
    """One row of totals over batch results."""
    return results.agg(
        F.count_if(F.col("failed") == 0).alias("batches_processed"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("total_processed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("total_failed"),
        F.coalesce(F.sum("schema_errors"), F.lit(0)).alias("total_schema_errors"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum("rows_rejected"), F.lit(0)).alias("rows_rejected"),
    )
