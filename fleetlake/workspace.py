"""The shared folder for intermediate tables and streaming checkpoints.

The cluster names it in ``spark.checkpoint.dir``; every executor must be able to reach it.  Only
a local master, where driver and executors are one process, may fall back to a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


class NoSharedFolder(RuntimeError):
    """The session names no folder that all executors can reach."""


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="fleetlake-")
    raise NoSharedFolder("set spark.checkpoint.dir to a folder that every executor can reach")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for one run; nothing is created until Spark writes to it."""
    return f"{shared_root(spark)}/fleetlake/{label}-{uuid.uuid4().hex}"


@contextmanager
def configured(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What is planned in here sees a setting; the session has its own again afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def few_listing_tasks(spark: SparkSession):
    """In here Spark looks up the given paths with four tasks a core instead of one a path; fewer, if set so.

    A micro-batch looks its files up as well, so a stream has to run in here as a whole.
    """
    tasks = min(int(spark.conf.get(_LISTING_TASKS)), 4 * spark.sparkContext.defaultParallelism)
    return configured(spark, _LISTING_TASKS, str(tasks))
