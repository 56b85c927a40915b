"""The clean table to all KPI tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tripmart.config import KpiSink
from tripmart.operators.kpis import CATALOGUE, CELL_MONTH, Kpi, kpi_cells, kpi_from_cells
from tripmart.operators.sketches import MONTH as SKETCH_MONTH
from tripmart.operators.sketches import month_sketches
from tripmart.sinks.snapshots import abandon, publish, start_run, written_parts
from tripmart.sinks.tables import drop_months, write_kpi
from tripmart.sources.trips import read_silver


def write_gold(trips: DataFrame, sink: KpiSink) -> dict[str, int]:
    """Write every KPI of the catalogue and return the row counts.

    The trips are scanned once and never cached: only the cells, a few thousand rows of sums,
    are kept while the tables are finished from them. Finishing is nine small jobs, which are
    submitted together, since each alone would leave the cluster idle.
    """
    cells = kpi_cells(trips).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cells.count()  # fills the cache, so that no two jobs compute the cells
        return finish_kpis(cells, sink)
    finally:
        cells.unpersist()


def finish_kpis(cells: DataFrame, sink: KpiSink) -> dict[str, int]:
    """Every KPI from cells that are at hand, and the row counts.

    With a versioned sink the tables become visible together, when the last one is written.
    """
    if sink.versioned:
        return _publish_kpis(cells, sink)

    def write(kpi: Kpi) -> int:
        return write_kpi(kpi_from_cells(cells, kpi, sort=False), kpi, sink)

    with ThreadPoolExecutor(len(CATALOGUE)) as pool:
        return dict(zip(CATALOGUE, pool.map(write, CATALOGUE.values())))


def _publish_kpis(cells: DataFrame, sink: KpiSink) -> dict[str, int]:
    spark = cells.sparkSession
    run = start_run(spark, sink.path)
    try:
        counts = finish_kpis(cells, replace(sink, path=run.folder, versioned=False))
        schemas = {name: kpi.schema for name, kpi in CATALOGUE.items()}
        publish(spark, run, written_parts(spark, run, counts), schemas)
    except Exception:
        abandon(spark, run)
        raise
    return counts


def refresh_cells(
    spark: SparkSession, silver: str, cells: str, months: list[tuple[int, int]] | None = None
) -> None:
    """Replace the stored cells of some months, or of all, by those of the clean table."""
    fresh = kpi_cells(read_silver(spark, silver, months), by_month=True)
    _replace_months(spark, fresh, cells, CELL_MONTH, months)


def _replace_months(
    spark: SparkSession,
    fresh: DataFrame,
    path: str,
    month_cols: tuple[str, str],
    months: list[tuple[int, int]] | None,
) -> None:
    """Write rows by month in place of some months, or of all; a month without rows goes."""
    mode = "static" if months is None else "dynamic"
    seen = Observation("months")
    written = fresh.observe(seen, F.collect_set(F.struct(*month_cols)).alias("months"))
    writer = written.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*month_cols).parquet(path)
    if months is not None:
        drop_months(spark, path, set(months) - {tuple(m) for m in seen.get["months"]}, *month_cols)


def run_gold(
    spark: SparkSession,
    silver: str,
    sink: KpiSink,
    months: list[tuple[int, int]] | None = None,
    cells: str | None = None,
) -> dict[str, int]:
    """Write all KPI tables from the whole clean table.

    With a folder for ``cells``, the sums and counts of each month are stored there; ``months``
    then reads only these months of the clean table, and the KPIs are finished from the cells of
    all months.
    """
    if cells is None:
        if months is not None:
            raise ValueError("to refresh some months, the cells of the others have to be stored")
        return write_gold(read_silver(spark, silver), sink)
    refresh_cells(spark, silver, cells, months)
    return finish_kpis(spark.read.parquet(cells), sink)


def refresh_sketches(
    spark: SparkSession, silver: str, sketches: str, months: list[tuple[int, int]] | None = None
) -> None:
    """Replace the stored sketches of some months, or of all, by those of the clean table."""
    fresh = month_sketches(read_silver(spark, silver, months))
    _replace_months(spark, fresh, sketches, SKETCH_MONTH, months)
