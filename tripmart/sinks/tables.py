"""Writers. Each runs its input once and takes the row count from that very run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.config import KpiSink, session_settings
from tripmart.functions.numeric import interleaved
from tripmart.operators.kpis import Kpi
from tripmart.schema import SILVER_PARTITIONS
from tripmart.sinks.snapshots import part_folder

# shuffled bytes per file of the clean table; Spark's default of 64 MB makes files too small
FILE_SHUFFLE_BYTES = "256m"
# the same where a task removes copies before it writes, so that its rows fit its memory
CLEANED_SHUFFLE_BYTES = "64m"
# months that a task writes side by side without sorting its rows; with more it sorts the rest
MONTHS_AT_ONCE = 12
ROWS_PER_FILE = 4_000_000
ROWS_PER_TASK = 500_000  # of a layout in smaller files


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written.

    The count sits in the stage that writes. A task of that stage is counted when it succeeds,
    once, even where earlier stages have to be run again.
    """
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


@dataclass(frozen=True)
class Written:
    """Rows written, and the months that they belong to."""

    rows: int
    months: tuple[tuple[int, int], ...]


def write_silver(
    trips: DataFrame, path: str, replace_all: bool = True, gathered: bool = False
) -> Written:
    """Write clean trips partitioned by month.

    Rows of a month are brought together first, else every task would add a file to every
    month. The rebalance hint leaves it to adaptive execution to cut large months into files
    of the advised size and to join small ones, so no month ends up in one task.
    ``replace_all=False`` replaces only the months that occur in ``trips``. ``gathered`` trips,
    as of ``clean(raw, by_time=True)``, are in ranges of time already and stay where they are.
    """
    rows = trips if gathered else trips.hint("rebalance", *SILVER_PARTITIONS)
    seen = Observation("silver")
    month = F.col("year") * 100 + F.col("month")
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(month).alias("months")
    )
    writer = (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*SILVER_PARTITIONS)
    )
    advised = {"spark__sql__adaptive__advisoryPartitionSizeInBytes": FILE_SHUFFLE_BYTES}
    if gathered:
        advised = {
            "spark__sql__adaptive__advisoryPartitionSizeInBytes": CLEANED_SHUFFLE_BYTES,
            "spark__sql__maxConcurrentOutputFileWriters": MONTHS_AT_ONCE,
        }
    with session_settings(trips.sparkSession, **advised):
        writer.parquet(path)
    months = tuple(sorted(divmod(m, 100) for m in seen.get["months"]))
    return Written(seen.get["rows"], months)


def write_by_zone(trips: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write clean trips by month, in files of neighbouring zones.

    Rows are dealt by ranges of month, interleaved pickup and drop-off zone, and time, so a
    frequent pair of zones is cut by time. Each file has narrow bounds of both zones, and a Parquet
    bloom filter of each tells row groups without a zone apart.
    """
    place = interleaved(F.col("PULocationID"), F.col("DOLocationID"))
    order = [F.col(c) for c in SILVER_PARTITIONS] + [place, F.col("pickup_datetime")]
    # a task writes its sorted rows in files of the size wanted; a month begins a file of its own in any case
    n_tasks = max(1, -(-trips.count() // max(rows_per_file, ROWS_PER_TASK)))
    dealt = trips.repartitionByRange(n_tasks, *order).sortWithinPartitions(*order)
    counted, seen = _counted(dealt, "by-zone")
    writer = counted.write.mode("append").partitionBy(*SILVER_PARTITIONS).option("maxRecordsPerFile", rows_per_file)
    for zone in ("PULocationID", "DOLocationID"):
        # sized by what a file can hold at most, else each would take a megabyte in the writer
        writer = writer.option(f"parquet.bloom.filter.enabled#{zone}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{zone}", rows_per_file
        )
    writer.parquet(path)
    return seen.get["rows"]


def drop_months(
    spark: SparkSession,
    path: str,
    months: Iterable[tuple[int, int]],
    year_col: str = "year",
    month_col: str = "month",
) -> None:
    """Delete the folders of some months of a table; a missing one is no error."""
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for year, month in months:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{year_col}={year}/{month_col}={month}")
        folder.getFileSystem(settings).delete(folder, True)


def _kpi_writer(df: DataFrame, name: str, sink: KpiSink) -> DataFrameWriter:
    writer = df.write.mode("overwrite").options(**sink.options)
    if sink.kind == "mongodb":
        return writer.format("mongodb").option("collection", name)
    return writer if sink.kind == "table" else writer.format(sink.kind)


def write_kpi(table: DataFrame, kpi: Kpi | str, sink: KpiSink) -> int:
    """Replace a KPI table in the sink and return its number of rows."""
    name = kpi if isinstance(kpi, str) else kpi.name
    counted, seen = _counted(table, name)
    writer = _kpi_writer(counted, name, sink)
    if sink.kind == "table":
        writer.saveAsTable(f"{sink.database}.{name}" if sink.database else name)
    elif sink.kind == "mongodb":
        if sink.database:
            writer = writer.option("database", sink.database)
        writer.save()
    else:
        if not sink.path:
            raise ValueError(f"a {sink.kind} sink needs a path")
        writer.save(f"{sink.path.rstrip('/')}/{name}")
    return seen.get["rows"]


def read_kpi(
    spark: SparkSession, kpi: Kpi, sink: KpiSink, version: int | None = None
) -> DataFrame:
    """A KPI table as it was written to a file or table sink, of a versioned sink the newest."""
    if sink.kind == "table":
        return spark.table(f"{sink.database}.{kpi.name}" if sink.database else kpi.name)
    reader = spark.read.schema(kpi.schema).format(sink.kind)
    if sink.versioned:
        return reader.load(part_folder(spark, sink.path, kpi.name, version))
    return reader.load(f"{sink.path.rstrip('/')}/{kpi.name}")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
