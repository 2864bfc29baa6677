"""Incoming files as a DataFrame of metadata; their content is not read.

Spark's reader lists a folder once and shows the visible files that have content.  Files of zero bytes
are in the same listing and looked up one by one; hidden names are asked for by a pattern of names.  Every
pass has the same lower bound on the modification time and covers the same dated folders.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import times
from fleetlake.functions.names import base_name
from fleetlake.sources.envelopes import ANY_JSON

LISTED = "file_path string, path string, file_name string, length long, modified_at timestamp"


def dated_folders(folder: str, layout: str, first_day: date, last_day: date) -> str:
    """The folders of some days as one pattern; ``layout`` is a date format such as ``%Y/%m/%d``."""
    days = (first_day + timedelta(days=n) for n in range((last_day - first_day).days + 1))
    return f"{folder.rstrip('/')}/{{{','.join(dict.fromkeys(d.strftime(layout) for d in days))}}}"


def _listing(spark: SparkSession, folders: str, pattern: str, recursive: bool, modified_after: datetime | None) -> DataFrame | None:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if modified_after is not None:
        cut = times.as_utc(modified_after)
        reader = reader.option("modifiedAfter", cut.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    try:
        return reader.load(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or "{" not in folders:
            raise
        return None  # none of the dated folders is there


def _shown(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        "path",
        base_name(F.col("path")).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified_at"),
    )


def list_incoming(
    spark: SparkSession,
    folder: str,
    pattern: str = ANY_JSON,
    recursive: bool = False,
    modified_after: datetime | None = None,
) -> DataFrame:
    """One row per visible file with content: ``file_path`` (its URI), ``path``, ``file_name, length, modified_at``.

    ``folder`` may be a pattern of folders.  ``modified_after`` keeps a listing short in a folder that is never
    emptied.  ``list_everything`` has empty and hidden files too.
    """
    files = _listing(spark, folder, pattern, recursive, modified_after)
    return spark.createDataFrame([], LISTED) if files is None else _shown(files)


def list_everything(
    spark: SparkSession,
    folder: str,
    pattern: str = ANY_JSON,
    recursive: bool = False,
    modified_after: datetime | None = None,
    depth: int = 0,
    staged: Callable[[DataFrame], tuple[DataFrame, int]] = lambda df: (df, df.count()),
) -> tuple[DataFrame, DataFrame | None, int]:
    """All files: the visible ones with content, the others if there are any, and how many folders deep they lie.

    Both have the columns of ``list_incoming``, the others ``hidden`` besides: true for hidden names, false for
    files of zero bytes.  ``staged`` may put the visible files somewhere and give them back with their number.
    With ``recursive`` hidden names are looked for as many folders deep as files were found, at least ``depth``.
    Hidden folders hold Spark's own files and are passed over.
    """
    files = _listing(spark, folder, pattern, recursive, modified_after)
    every = [] if files is None else files.inputFiles()
    shown, n_shown = staged(_shown(files) if every else spark.createDataFrame([], LISTED))
    if recursive and every:
        depth = max(depth, max(p.split("://")[-1].count("/") for p in every) - _depth_of(spark, folder))
    statuses = [(s, True) for s in _matching(spark, folder, "[_.]" + pattern, depth if recursive else 0)]
    if len(every) > n_shown:
        names = spark.createDataFrame([(p,) for p in every], "file_path string")
        for row in names.join(shown.select("file_path"), "file_path", "left_anti").collect():  # the empty ones
            status = _status(spark, row.file_path)
            statuses += [(status, False)] * (status.getLen() == 0)
    least = -1 if modified_after is None else int(times.as_utc(modified_after).timestamp() * 1000)
    rows = [
        (s.getPath().toUri().toString(), s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime(), hidden)
        for s, hidden in statuses
        if s.getModificationTime() >= least
    ]
    if not rows:
        return shown, None, depth
    found = spark.createDataFrame(rows, "file_path string, path string, file_name string, length long, ms long, hidden boolean")
    return shown, found.withColumn("modified_at", F.timestamp_millis("ms")).drop("ms"), depth


def _path(spark: SparkSession, text: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _status(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(uri))
    return _file_system(spark, path).getFileStatus(path)


def _depth_of(spark: SparkSession, folder: str) -> int:
    """Slashes in the full path of a file that lies directly in ``folder``, or in the first folder of a pattern."""
    path = _path(spark, re.sub(r"\{([^,}]*)[^}]*\}", r"\1", folder))
    return _file_system(spark, path).makeQualified(path).toUri().getPath().rstrip("/").count("/") + 1


def _matching(spark: SparkSession, folder: str, pattern: str, depth: int) -> list:
    """Status of the files whose names fit, up to ``depth`` folders down."""
    found = []
    for levels in range(depth + 1):
        path = _path(spark, "/".join([folder.rstrip("/"), *["*"] * levels, pattern]))
        found += [s for s in _file_system(spark, path).globStatus(path) or () if s.isFile()]
    return found
