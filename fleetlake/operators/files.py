"""Operators on file metadata: classify, group, keep only what was not loaded before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import names, times
from fleetlake.registry import UNKNOWN_TYPE


def classify(files: DataFrame, ingest_date: Column | None = None, name: str = "file_name") -> DataFrame:
    """Adds ``file_type``, ``match_kind`` and the arrival ``date`` (null for a bad stamp).

    ``match_kind`` is ``strict`` for a name that follows the convention, ``fallback`` for one
    that merely contains a type, ``none`` for an unknown file.
    """
    column = F.col(name)
    today = times.utc_today() if ingest_date is None else ingest_date
    strict, contained = F.col("strict_type"), F.col("contained_type")
    matched = files.withColumns(
        {
            "strict_type": names.strict_type(column),
            "contained_type": names.contained_type(column),
            "stamp": names.stamp_of(column),
        }
    )
    return matched.withColumns(
        {
            "date": names.partition_date(F.col("stamp"), today),
            "file_type": F.coalesce(strict, contained, F.lit(UNKNOWN_TYPE)),
            "match_kind": F.when(strict.isNotNull(), "strict")
            .when(contained.isNotNull(), "fallback")
            .otherwise("none"),
        }
    ).drop("strict_type", "contained_type", "stamp")


def file_day(name: str = "file_name", modified_at: str = "modified_at") -> Column:
    """The day under which the ledger keeps a file: that of its stamp, else of its modification.

    Unlike the arrival date of a file without a stamp it does not depend on when the file is listed.
    """
    modified = times.instant_to_utc(F.col(modified_at)).cast("date")
    return F.coalesce(stamp_day(F.col(name)), modified)


def stamp_day(name: Column) -> Column:
    """The date in a file name's stamp, null without a valid one."""
    return names.partition_date(names.stamp_of(name), F.lit(None).cast("date"))


def group_by_type(files: DataFrame) -> DataFrame:
    """Files per type.  The files themselves stay rows, so no list grows without bound."""
    return files.groupBy("file_type").agg(F.count("*").alias("files"))


def not_loaded(files: DataFrame, ledger: DataFrame, key: str = "file_path", retry_failed: bool = False) -> DataFrame:
    """Files that the ledger does not know.  With ``retry_failed`` only processed files count as done.

    Where both sides have ``length`` and ``modified_at``, a file delivered again under an old name is
    a new file.  The join carries no broadcast hint: Spark decides by the ledger's size at run time.
    """
    done = ledger.where(F.col("state").isin("processed", *([] if retry_failed else ["failed"])))
    both = {*files.columns} & {*ledger.columns}
    marks = [c for c in ("length", "modified_at") if c in both]
    known = done.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in marks))
    same = F.col(key) == F.col("_key")
    for c in marks:
        same = same & (F.col(f"_{c}").isNull() | (F.col(c) == F.col(f"_{c}")))
    return files.join(known, same, "left_anti")
