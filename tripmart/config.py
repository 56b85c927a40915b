"""Configuration objects shared by the operators and plans."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import quote_plus

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: trip times carry no zone and are read as wall-clock values."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# HotSpot never compiles a longer method, it is interpreted for every row
COMPILED_METHOD_BYTES = 8000


def use_compiled_code(spark: SparkSession) -> SparkSession:
    """Have stages whose generated method is too long to be compiled run operator by operator.

    By default Spark does so from 64 KB on only. A setting of the session, as tables are lazy.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, below the folder the cluster shares.

    ``spark.checkpoint.dir`` names that folder. Without it the warehouse folder is used, which is
    always set and shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tripmart-{label}-{uuid.uuid4().hex}"


@contextmanager
def session_settings(spark: SparkSession, **settings: object) -> Iterator[None]:
    """Settings for the actions inside the block; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): str(value) for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@dataclass(frozen=True)
class CleaningRules:
    """Plausibility bounds of a trip. Closed ranges, except that a duration is above zero.

    ``min_total`` and the two dates are stricter rules that are off by default.
    """

    # fixed values: bounds of a plausible trip
    min_fare: float = 0.0
    max_fare: float = 500.0
    min_distance: float = 0.1
    max_distance: float = 100.0
    min_passengers: int = 1
    max_passengers: int = 6
    max_duration_minutes: float = 180.0
    # extensions
    min_total: float | None = None
    first_date: str | None = None
    last_date: str | None = None

    def checks(self) -> dict[str, Column]:
        """Named predicates, in the order in which a failing row is accounted for."""
        minutes = F.col("trip_duration_minutes")
        checks = {
            "fare_out_of_range": F.col("fare_amount").between(self.min_fare, self.max_fare),
            "distance_out_of_range": F.col("trip_distance").between(
                self.min_distance, self.max_distance
            ),
            "passengers_out_of_range": F.col("passenger_count").between(
                self.min_passengers, self.max_passengers
            ),
            "duration_out_of_range": (minutes > 0) & (minutes <= self.max_duration_minutes),
        }
        if self.min_total is not None:
            checks["total_below_minimum"] = F.col("total_amount") >= self.min_total
        day = F.to_date("pickup_datetime")
        if self.first_date is not None:
            checks["before_first_date"] = day >= F.lit(self.first_date).cast("date")
        if self.last_date is not None:
            checks["after_last_date"] = day <= F.lit(self.last_date).cast("date")
        return checks


@dataclass(frozen=True)
class SourceSpec:
    """A raw source: where its files lie, which of them count, and how they are landed.

    ``layout`` is ``rows`` for columnar files, whose rows are copied as they are, or ``files``
    for small documents, which are kept byte for byte in a table of files.
    """

    name: str
    folder: str
    pattern: str
    layout: str = "files"


def default_sources(root: str) -> tuple[SourceSpec, ...]:
    """The three raw sources, each in its own folder below ``root``."""
    root = root.rstrip("/")
    return (
        SourceSpec("taxi", f"{root}/taxi", "*.parquet", layout="rows"),
        SourceSpec("weather", f"{root}/weather", "*.json"),
        SourceSpec("news", f"{root}/news", "*.xml"),
    )


@dataclass(frozen=True)
class KpiSink:
    """Where KPI tables go: a file format below ``path``, catalogue tables, or documents.

    ``versioned`` files are published together: readers see all tables of one run.
    """

    kind: str = "parquet"  # parquet | json | table | mongodb
    path: str | None = None
    database: str | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)  # may hold a password
    versioned: bool = False

    def __post_init__(self):
        if self.versioned and self.kind not in ("parquet", "json"):
            raise ValueError(f"a {self.kind} sink has no versions")

    @classmethod
    def mongodb_from_env(cls, env: Mapping[str, str] | None = None) -> KpiSink:
        """A document sink whose address and credentials come from the environment only."""
        env = os.environ if env is None else env
        database = env.get("MONGO_DB", "taxi_gold")
        host = env.get("MONGO_HOST", "mongodb:27017")
        user, password = env.get("MONGO_USER"), env.get("MONGO_PASSWORD")
        if not user or not password:
            raise ValueError("MONGO_USER and MONGO_PASSWORD must be set")
        login = f"{quote_plus(user)}:{quote_plus(password)}"
        uri = f"mongodb://{login}@{host}/{database}?authSource=admin"
        return cls(kind="mongodb", database=database, options={"connection.uri": uri})
