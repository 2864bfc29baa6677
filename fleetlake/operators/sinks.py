"""Writing to the lake: each function runs one write."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlake import workspace
from fleetlake.registry import DRIFT, EVENT_DAYS, FILE_DAY, LEDGER, MARKS, REJECTS, REPLAYS, STORED_SUMMARY, changes_of
from fleetlake.sources.tables import NO_VALUE, read_table

#: Files that a task of a partitioned write has open at a time.
OPEN_WRITERS = 16


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts rows as they are written, so that no rescan is needed.

    It has to sit after any shuffle: stages before one can run again and would count twice.
    """
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows")), written


def _open_writers(spark: SparkSession):
    """A write in here sorts no rows until a task has more than ``OPEN_WRITERS`` partitions, and then the others only.

    A rebalanced task has few partitions, and its rows in memory, to be sorted, take many times what they take as
    Parquet.
    """
    return workspace.configured(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_WRITERS))


def append_partitioned(
    df: DataFrame, path: str, partition: str = "date", by_partition: bool = True
) -> int:
    """Appends to a table partitioned by ``partition``; returns the number of rows.

    ``by_partition`` rebalances first: without it every task opens a file per date.  The rebalance
    splits a date that holds much of the data over several tasks and merges small ones, so no date
    has to pass through a single task.
    """
    laid_out = df.hint("rebalance", F.col(partition)) if by_partition else df
    rows, written = _counted(laid_out)
    with _open_writers(df.sparkSession):
        rows.write.mode("append").partitionBy(partition).parquet(path)
    return written.get["rows"]


def overwrite_days(df: DataFrame, path: str, partition: str = "day") -> int:
    """Replaces the days present in ``df`` and leaves all others alone; returns the row count."""
    rows, written = _counted(df.hint("rebalance", F.col(partition)))
    with _open_writers(df.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
    return written.get["rows"]


def append_changes(df: DataFrame, path: str) -> int:
    """Appends changed summary rows beside the stored summary at ``path``; returns their number.

    Nothing stored is read or written again: the cost follows the rows that changed.
    """
    missing = {f.name: F.lit(None).cast(f.dataType) for f in STORED_SUMMARY if f.name not in df.columns}
    rows = df.withColumns(missing).select(*STORED_SUMMARY.names)
    return append_partitioned(rows, changes_of(path), "day")


def has_files(spark: SparkSession, path: str, column: str, value: str) -> bool:
    return len(_matching(spark, f"{path}/{column}={value}/*.parquet")) > 0


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The partition values of a table that have files, by a listing of its folders."""
    return [v for v in folders(spark, path, column) if has_files(spark, path, column, v)]


def folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """The partition values of a table, by its folders alone."""
    names = (s.getPath().getName().split("=", 1)[1] for s in _matching(spark, f"{path}/{column}=*"))
    return sorted(v for v in names if v != NO_VALUE)


def _matching(spark: SparkSession, pattern: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or ()


def stage(df: DataFrame, label: str, *partition: str) -> DataFrame:
    """Writes ``df`` to a fresh table in the shared folder and reads it back.

    What follows reads fixed bytes: a lost executor cannot make it see its inputs change, and the
    work before it is not done twice.
    """
    path = workspace.work_dir(df.sparkSession, label)
    df.write.partitionBy(*partition).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def stage_counted(df: DataFrame, label: str, **facts: Column) -> tuple[DataFrame, dict]:
    """The same with the number of ``rows`` and other aggregates, taken as they are written."""
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in facts.items()))
    return stage(rows, label), written.get


def stage_parts_counted(parts: Iterable[DataFrame], label: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The same for one table in several parts of one schema, each a job of its own; the counts are added up."""
    path, totals = None, Counter()
    for part in parts:
        path = path or workspace.work_dir(part.sparkSession, label)
        written = Observation()
        rows = part.observe(written, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in counts.items()))
        rows.write.mode("append").parquet(path)
        totals.update(written.get)
    return read_table(part.sparkSession, path, part.schema), dict(totals)


def replace_partitions(table: DataFrame, keep: Column, path: str, column: str, values: Sequence[str]) -> None:
    """Rewrites partitions of the table at ``path`` with what ``keep`` keeps of them; emptied ones go."""
    left = stage(table.where(keep), "kept-rows")
    overwrite_days(left, path, column)
    there = {str(r[0]) for r in left.select(F.col(column).cast("string")).distinct().collect()}  # partitions
    drop_partitions(table.sparkSession, path, column, [v for v in values if v not in there])


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    """Removes whole partitions of a table; absent ones are no error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for value in values:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        folder.getFileSystem(conf).delete(folder, True)


def _append(df: DataFrame, path: str, schema: StructType, partition: str) -> None:
    df.select(*schema.names).hint("rebalance", F.col(partition)).write.mode("append").partitionBy(partition).parquet(path)


def append_rejects(df: DataFrame, path: str) -> None:
    _append(df, path, REJECTS, "file_type")


def append_event_days(df: DataFrame, path: str) -> None:
    _append(df, path, EVENT_DAYS, "file_type")


def append_drift(df: DataFrame, path: str) -> None:
    _append(df, path, DRIFT, "file_type")


def append_replays(df: DataFrame, path: str) -> None:
    _append(df, path, REPLAYS, "file_type")


def append_ledger(df: DataFrame, path: str) -> None:
    _append(df, path, LEDGER, FILE_DAY)


def append_open_batch(df: DataFrame, path: str) -> None:
    _append(df, path, LEDGER, "batch_id")


def write_mark(df: DataFrame, path: str) -> None:
    """Replaces the mark of the folder that ``df`` is about; those of other folders stay."""
    overwrite_days(df.select(*MARKS.names), path, "folder_key")


def partition_files(spark: SparkSession, path: str, column: str, value: str) -> list[str]:
    """The data files of one partition of a table, by a listing of its folder alone."""
    return [s.getPath().toString() for s in _matching(spark, f"{path}/{column}={value}/*.parquet")]


def delete_files(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes data files that hold nothing that other files do not hold as well."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        file = jvm.org.apache.hadoop.fs.Path(path)
        file.getFileSystem(conf).delete(file, False)


def compact_partitions(spark: SparkSession, path: str, schema: StructType, column: str, values: Iterable[str], max_files: int) -> list[str]:
    """Gathers the rows of partitions with more than ``max_files`` files into new files; returns those partitions.

    The new files are there before the old ones go, so a crash leaves rows twice and never loses one: for
    tables whose readers don't mind a row that is there twice.  Repeated rows are written once.
    """
    values = list(values)
    if len(_matching(spark, f"{path}/{column}={{{','.join(values)}}}/*.parquet")) < len(values) + max_files:
        return []  # not even if all but one had a single file
    old = {v: f for v in values if len(f := partition_files(spark, path, column, v)) > max_files}
    if old:
        rows = read_table(spark, path, schema).where(F.col(column).isin([F.lit(v).cast(schema[column].dataType) for v in old]))
        gathered = stage(rows.distinct(), "compacted")
        gathered.hint("rebalance", F.col(column)).write.mode("append").partitionBy(column).parquet(path)
        for files in old.values():
            delete_files(spark, files)
    return list(old)
