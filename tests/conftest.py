from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetlake.registry import Lake  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fleetlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    """Runs a test under two session zones; results must not differ."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def incoming(tmp_path):
    return Incoming(tmp_path / "incoming")


class Incoming:
    """A folder of real envelope files."""

    def __init__(self, folder: Path):
        self.folder = folder
        folder.mkdir()

    def __str__(self) -> str:
        return str(self.folder)

    def put(self, name: str, content) -> str:
        path = self.folder / name
        path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
        return str(path)

    def events(self, stamp: str, *records: dict, key: str = "vehicles_events") -> str:
        return self.put(f"vehicles_events_{stamp}.json", {key: list(records)})


def event(vehicle="V1", time="2025-11-08T10:30:00Z", kind="start_drive", source="sensor", **more) -> dict:
    return {
        "vehicle_id": vehicle,
        "event_time": time,
        "event_source": source,
        "event_type": kind,
        **more,
    }


def status(vehicle="V1", time="2025-11-08T10:30:00Z") -> dict:
    return {"vehicle_id": vehicle, "report_time": time, "status_source": "garage", "status": "parked"}
