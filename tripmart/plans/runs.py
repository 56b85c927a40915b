"""What a run did: rows read, kept and rejected, duration and rate."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tripmart.sinks.tables import append_rows

RUN_METRICS = (
    "job string, started_at timestamp, rows_in bigint, rows_out bigint, rows_rejected bigint, "
    "seconds double, rows_per_second double"
)


@dataclass(frozen=True)
class RunMetrics:
    job: str
    started_at: datetime
    rows_in: int
    rows_out: int
    rows_rejected: int
    seconds: float
    rows_per_second: float

    def as_row(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([asdict(self)], RUN_METRICS)


def measured(job: str, rows_in: int, run: Callable[[], int]) -> RunMetrics:
    """Time a run that returns the number of rows it wrote."""
    started, clock = datetime.now(timezone.utc), time.monotonic()
    rows_out = run()
    seconds = time.monotonic() - clock
    rate = rows_in / seconds if seconds else 0.0
    return RunMetrics(job, started, rows_in, rows_out, rows_in - rows_out, seconds, rate)


def record(spark: SparkSession, metrics: RunMetrics, path: str) -> None:
    """Append a run to the table of runs."""
    append_rows(metrics.as_row(spark).coalesce(1), path)
