"""Lake tables: partition scans, definitions, views and the catalog."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from fleetlake.sources.envelopes import literal_path
from fleetlake.registry import (
    EXTRA_DATA_FIELDS,
    FILE_TYPES,
    STORED_SUMMARY,
    SUMMARY,
    SUMMARY_VIEW_ORDER,
    TIE,
    Lake,
    changes_of,
)

# The two namespaces of the lake, raw tables first.
DATABASES = ("raw_data", "reports")
#: The folder name of a partition without a value, as Spark writes it.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class ManagedTable(ValueError):
    """A table stands where a view or an external table should, and dropping it would delete data."""


class StreamedTable(ValueError):
    """The catalog can't define a table that a stream writes."""


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table under its declared schema."""
    return spark.read.schema(schema).parquet(path)


def open_table(spark: SparkSession, path: str, schema: StructType, partition: str) -> DataFrame:
    """The same for a table that may not exist yet: it then has no rows.  Nothing is written."""
    return read_table(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def is_streamed(spark: SparkSession, path: str) -> bool:
    """Whether a stream's file sink writes the table: its commit log then says which files count."""
    return exists(spark, f"{path}/_spark_metadata")


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def scan_partitions(
    spark: SparkSession, path: str, schema: StructType, values: Sequence[str], column: str = "date"
) -> DataFrame:
    """The given partitions of a table; absent ones, even all of them, contribute no rows.

    Only their folders are listed, so the cost does not grow with the age of the table.  A streamed
    table is read by its commit log and then filtered: its folders may hold files that do not count.
    """
    if is_streamed(spark, path):
        return read_table(spark, path, schema).where(F.col(column).isin([F.lit(v).cast(schema[column].dataType) for v in values]))
    folders = f"{literal_path(path)}/{column}={{{','.join(values)}}}"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def in_partitions(table: DataFrame, days: Sequence[date], column: str = "date") -> DataFrame:
    """The same as a filter on a table at hand, which prunes its partitions."""
    return table.where(F.col(column).isin([F.lit(d) for d in days]))


# --- definitions --------------------------------------------------------------------------


def _sql_type(field: StructField) -> str:
    """The type's SQL name; plain ``timestamp`` could mean either kind, as the session is set."""
    return "timestamp_ltz" if field.dataType == TimestampType() else field.dataType.simpleString()


def _layout(lake: Lake, databases: tuple[str, str]) -> list[tuple[str, str, StructType, str, str]]:
    """(database, table, schema, partition column, location) of the three public tables."""
    raw, reports = databases
    tables = [(raw, t.name, t.table, t.partition_column, lake.raw(t.name)) for t in FILE_TYPES.values()]
    return [*tables, (reports, "daily_summary", SUMMARY, "day", lake.summary)]


def create_databases(spark: SparkSession, lake: Lake, databases: tuple[str, str] = DATABASES) -> None:
    for name in databases:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{lake.base.rstrip('/')}/{name}'")


def _drop_any(spark: SparkSession, name: str) -> None:
    """Drops a view or an external table, with which no data goes.  Refuses a managed table."""
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind == "MANAGED":
            raise ManagedTable(f"{name} is a managed table; dropping it would delete its data")
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {name}")


def create_tables(spark: SparkSession, lake: Lake, databases: tuple[str, str] = DATABASES) -> None:
    """External partitioned tables with declared schemas, for a catalog shared by many readers.

    New partitions need ``spark.catalog.recoverPartitions``; ``create_views`` needs nothing.  The summary's table
    shows what ``compact_summary`` has folded in.  A table
    that a stream writes can't be defined so and is refused: the catalog would not keep its commit log.
    """
    create_databases(spark, lake, databases)
    for database, table, schema, partition, location in _layout(lake, databases):
        if is_streamed(spark, location):
            raise StreamedTable(f"{location} is written by a stream; use create_views")
        name = f"{database}.{table}"
        _drop_any(spark, name)
        columns = ", ".join(f"`{f.name}` {_sql_type(f)}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"PARTITIONED BY (`{partition}`) LOCATION '{location}'"
        )


# --- views --------------------------------------------------------------------------------


def _extra_data_struct() -> str:
    fields = ", ".join(
        f"'{name}', try_cast(event_extra_data['{name}'] AS {kind})" for name, kind in EXTRA_DATA_FIELDS
    )
    return f"CASE WHEN event_extra_data IS NOT NULL THEN named_struct({fields}) END AS event_extra_data"


def _view_columns(order: Sequence[str]) -> str:
    """Presentation columns.  ``day`` is text; Spark would read a date from the folder name."""
    special = {"event_extra_data": _extra_data_struct(), "day": "CAST(day AS STRING) AS day", "date": "CAST(date AS DATE) AS date"}
    return ", ".join(special.get(c, c) for c in order)


def _latest_rows(columns: str, location: str, with_ties: bool) -> str:
    """The stored summary and its changes, as ``plans.summary.stored_summary`` reads them."""
    stored = "vehicle_id, last_event_time, last_event_type, CAST(day AS STRING) AS day"
    ties = TIE if with_ties else f"CAST(NULL AS array<string>) AS {TIE}"
    return f"""
        WITH base AS (SELECT {stored}, {ties} FROM parquet.`{location}`),
        changes AS (SELECT {stored}, {TIE} FROM parquet.`{changes_of(location)}`),
        changed AS (SELECT DISTINCT day FROM changes WHERE day IS NOT NULL),
        candidates AS (SELECT * FROM base WHERE day IN (SELECT day FROM changed) UNION ALL SELECT * FROM changes),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY vehicle_id, day ORDER BY last_event_time DESC, {TIE} DESC, last_event_type DESC) AS rn
          FROM candidates
        )
        SELECT {columns} FROM base LEFT ANTI JOIN changed USING (day)
        UNION ALL SELECT {columns} FROM ranked WHERE rn = 1"""


def _make_readable(spark: SparkSession, location: str, schema: StructType, partition: str) -> None:
    """Gives a table without files one without rows, from which Spark can tell its columns."""
    if not open_table(spark, location, schema, partition).inputFiles():
        bare = StructType([f for f in schema if f.name != partition])
        spark.createDataFrame([], bare).write.mode("append").parquet(f"{location}/{partition}={NO_VALUE}")


def create_views(spark: SparkSession, lake: Lake, databases: tuple[str, str] = DATABASES) -> None:
    """``raw_data.*`` and ``reports.*`` as views over the Parquet folders, columns in reading order.

    A view lists its folder anew for each query, so new files and partitions show up unasked.  A table
    without files is given one without rows, so that its view is right before and after the first load.
    The summary's view shows changes that are not folded in yet.
    """
    create_databases(spark, lake, databases)
    for database, table, schema, partition, location in _layout(lake, databases):
        name = f"{database}.{table}"
        _drop_any(spark, name)
        if table == "daily_summary":
            for place in (location, lake.summary_changes):
                _make_readable(spark, place, STORED_SUMMARY, partition)
            with_ties = TIE in spark.read.parquet(location).columns
            body = _latest_rows(", ".join(SUMMARY_VIEW_ORDER), location, with_ties)
        else:
            _make_readable(spark, location, schema, partition)
            body = f"SELECT {_view_columns(FILE_TYPES[table].view_order)} FROM parquet.`{location}`"
        spark.sql(f"CREATE VIEW {name} AS {body}")


def catalog_listing(spark: SparkSession, databases: tuple[str, str] = DATABASES) -> DataFrame:
    """``table_schema, table_name`` of everything in the two databases, in that order."""
    shown = [
        spark.sql(f"SHOW TABLES IN {name}").where(~F.col("isTemporary"))
        for name in databases
        if spark.catalog.databaseExists(name)
    ]
    columns: list[Column] = [F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name")]
    listing = shown[0].select(columns)
    for more in shown[1:]:
        listing = listing.unionByName(more.select(columns))
    return listing.orderBy("table_schema", "table_name")
