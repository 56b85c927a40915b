from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripmart-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


class Trips:
    """Builds raw trips from a plausible one, with single values changed."""

    SCHEMA = (
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, trip_distance double, "
        "passenger_count double, fare_amount double, total_amount double, tip_amount double, "
        "tolls_amount double, payment_type bigint, PULocationID bigint, DOLocationID bigint, "
        "note string"
    )
    PLAUSIBLE = {
        "pickup_datetime": "2024-03-06 10:00:00",  # a Wednesday
        "dropoff_datetime": "2024-03-06 10:30:00",
        "trip_distance": 5.0,
        "passenger_count": 1.0,
        "fare_amount": 20.0,
        "total_amount": 25.0,
        "tip_amount": 2.0,
        "tolls_amount": 0.0,
        "payment_type": 1,
        "PULocationID": 10,
        "DOLocationID": 20,
        "note": "a",
    }

    def __init__(self, spark):
        self.spark = spark

    def __call__(self, *changes: dict):
        from datetime import datetime

        rows = []
        for change in changes:
            row = self.PLAUSIBLE | change
            for name in ("pickup_datetime", "dropoff_datetime"):
                if isinstance(row[name], str):
                    row[name] = datetime.fromisoformat(row[name])
            rows.append(row)
        return self.spark.createDataFrame(rows, self.SCHEMA)


@pytest.fixture
def trips(spark):
    return Trips(spark)
