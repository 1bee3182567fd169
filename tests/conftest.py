from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from contrail.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "contrail-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CLEAN_SCHEMA = """icao24 string, origin_country string, latitude double, longitude double,
  time_position timestamp_ntz, last_contact timestamp_ntz, velocity double, vertical_rate double,
  true_track double, baro_altitude double, geo_altitude double, on_ground boolean,
  ingestion_time timestamp_ntz, source_file string"""

DEFAULTS = {
    "icao24": "abc123",
    "origin_country": "France",
    "latitude": 10.0,
    "longitude": 20.0,
    "time_position": datetime(2024, 1, 1, 10),
    "last_contact": datetime(2024, 1, 1, 10, 0, 1),
    "velocity": 200.0,
    "vertical_rate": 0.0,
    "true_track": 90.0,
    "baro_altitude": 5000.0,
    "geo_altitude": 5050.0,
    "on_ground": False,
    "ingestion_time": datetime(2024, 1, 1, 11),
    "source_file": "a.json",
}


@pytest.fixture(scope="session")
def reports(spark):
    """Bronze-view rows from partial dicts; the rest takes default values."""

    def build(*rows: dict):
        return spark.createDataFrame([tuple({**DEFAULTS, **r}.values()) for r in rows], CLEAN_SCHEMA)

    return build


@pytest.fixture()
def at():
    """A moment on 1 January 2024 (or another day of that month)."""
    return lambda hour=0, minute=0, second=0, day=1: datetime(2024, 1, day, hour, minute, second)
