"""Fields that no schema names: which, of what type, how often, by arrival day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.registry import EXTRA


def json_type(text: Column) -> Column:
    """The type that a field's value reads as; a quoted number can't be told from a plain one."""
    head = F.left(F.ltrim(text), F.lit(1))
    return (
        F.when(text.isNull(), "null")
        .when(head == "{", "object")
        .when(head == "[", "array")
        .when(text.isin("true", "false"), "boolean")
        .when(text.try_cast("bigint").isNotNull(), "integer")
        .when(text.try_cast("double").isNotNull(), "number")
        .otherwise("string")
    )


def unknown_fields(records: DataFrame, partition: str = "date") -> DataFrame:
    """``date, field, type, records`` over records with ``_extra_fields``: one row for each kind of new field and day.

    Rows are added up in every map task before they are shuffled, so a field of a third of all records
    costs no more than another.
    """
    fields = records.where(F.col(EXTRA).isNotNull()).select(F.col(partition).alias("date"), F.explode(EXTRA).alias("field", "value"))
    return fields.groupBy("date", "field", json_type(F.col("value")).alias("type")).agg(F.count("*").alias("records"))
