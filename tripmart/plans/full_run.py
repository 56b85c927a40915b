"""All jobs in order: land, clean, aggregate, train."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import SparkSession

from tripmart.config import CleaningRules, KpiSink, default_sources
from tripmart.plans.gold import run_gold
from tripmart.plans.runs import RunMetrics, measured, record
from tripmart.plans.silver import run_silver
from tripmart.plans.training import run_training
from tripmart.operators.learning import Training
from tripmart.sources.landing import NothingLanded, land_source

T = TypeVar("T")


@dataclass
class FullRun:
    landed: dict[str, int]
    silver: RunMetrics
    kpis: dict[str, int]
    training: Training


def run_all(
    spark: SparkSession,
    raw: str,
    lake: str,
    rules: CleaningRules = CleaningRules(),
    sink: KpiSink | None = None,
) -> FullRun:
    """Run every stage; stages hand over through tables below ``lake`` only.

    Each is put on record in ``run_metrics``: landing counts files, the KPI tables and the training
    the rows they wrote or learned from, out of those of the clean table.
    """
    lake = lake.rstrip("/")
    runs, silver = f"{lake}/run_metrics", f"{lake}/silver/taxi"

    def kept(job: str, rows_in: int, run: Callable[[], T], rows_of: Callable[[T], int]) -> T:
        """Run a job and put it on record."""
        done: list[T] = []

        def counted() -> int:
            done.append(run())
            return rows_of(done[0])

        record(spark, measured(job, rows_in, counted), runs)
        return done[0]

    landed: dict[str, int] = {}
    for source in default_sources(raw):
        n_files = kept(f"land {source.name}", 0, lambda: land_source(spark, source, f"{lake}/bronze"), int)
        landed[source.name] = n_files
    if not sum(landed.values()):
        raise NothingLanded("no file was found for any source")
    metrics = run_silver(spark, f"{lake}/bronze/taxi", silver, rules)
    record(spark, metrics, runs)
    sink = sink or KpiSink(path=f"{lake}/gold")
    kpis = kept("gold", metrics.rows_out, lambda: run_gold(spark, silver, sink), lambda k: sum(k.values()))
    training = kept(
        "training",
        metrics.rows_out,
        lambda: run_training(spark, silver, f"{lake}/models/taxi_price"),
        lambda t: sum(t.sizes.values()),
    )
    return FullRun(landed, metrics, kpis, training)
