from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonecast.config import preset  # noqa: E402

HISTORY = "zone_id bigint, zone_name string, hour_ts timestamp_ntz, trip_count bigint, avg_fare double, avg_distance double"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("zonecast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return preset("taxi")


def hours(start: datetime, n: int):
    return [start + timedelta(hours=i) for i in range(n)]


def demand(zone: int, ts: datetime) -> int:
    """Trips of the formula-built history."""
    return 0 if zone == 3 and ts.hour < 5 else zone * ts.hour + ts.weekday()


@pytest.fixture(scope="session")
def history(spark, cfg):
    """Zones 1-3, every hour from December to February, without noise."""
    rows = []
    for zone in (1, 2, 3):
        for ts in hours(cfg.start, 2184):
            n = demand(zone, ts)
            money = (None, None) if n == 0 else (10.0 + zone, 2.0)
            rows.append((zone, f"Zone {zone}", ts, n, *money))
    return spark.createDataFrame(rows, HISTORY).cache()
