"""Blocks of queries and blocks of data, dealt to tasks that hold a bounded number of each."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def groups_of(blocks: int, per_group: int) -> int:
    """How many groups hold about ``per_group`` blocks each."""
    return max(1, -(-blocks // per_group))


def group_number(block: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(groups)).cast("int")


def met(asking: DataFrame, asked: DataFrame, visit: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``visit`` over the rows of both that have the same ``ask_group`` and ``block_group``.

    Each row is one block; a block that must meet several groups of the other side comes once for each.
    """
    keys = ["ask_group", "block_group"]
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))  # both may come from one table of pairs
    return asking.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(visit, schema)
