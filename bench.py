"""Times every query; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads.  What several queries start from (the
landed files, the lakes) is made first, under entries of its own that count.  Each query runs twice and
the faster run counts; queries that write do all their writing each time.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from workload import tables
from workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("fleetlake-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fleetlake-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


PREPARED = (tables.landed, tables.events_lake, tables.viewed_lake, tables.landed_defective)


def run(spark: SparkSession, name: str) -> None:
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    seconds = {f"prepare_{make.__name__}": round(timed(lambda m=make: m(spark, SF_DIR)), 3) for make in PREPARED}
    seconds |= {
        name: round(min(timed(lambda n=name: run(spark, n)) for _ in range(RUNS)), 3) for name in QUERIES
    }
    line = {
        "metric": "total seconds over all queries and what they start from",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
