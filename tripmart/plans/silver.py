"""Raw trips to the clean table."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import CleaningRules, scratch_path, session_settings
from tripmart.functions.columns import free_name
from tripmart.operators.cleaning import clean, picked_up_between, pickup_month
from tripmart.plans.runs import RunMetrics, measured
from tripmart.sinks.snapshots import (
    Run,
    abandon,
    delete_folder,
    has_files,
    is_published,
    part_name,
    publish,
    start_run,
    written_files,
)
from tripmart.sinks.tables import ROWS_PER_FILE, write_by_zone, write_silver
from tripmart.sources.documents import file_inventory
from tripmart.sources.trips import LANDED_FILE, read_bronze, read_silver, trips_by_file

Month = tuple[int, int]

# raw bytes, as compressed in the files, that one task of the deduplication takes on
BYTES_PER_TASK = 128 * 1024 * 1024
# raw bytes that are shuffled together: some thousands of tasks
BYTES_PER_BATCH = 512 * 1024 * 1024 * 1024
# scans of the raw rows by all batches together, beyond which the rows are dealt to the batches first
MOST_SCANS = 4


def shuffle_partitions_for(spark: SparkSession, nb_bytes: int) -> int:
    """Enough partitions for so many raw bytes; never fewer than the session asks for."""
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(asked, math.ceil(nb_bytes / BYTES_PER_TASK))


def raw_bytes(spark: SparkSession, bronze: str) -> int:
    return file_inventory(spark, bronze, "*.parquet").agg(F.sum("nb_bytes")).first()[0] or 0


def rows_by_month(raw: DataFrame) -> dict[Month | None, int]:
    """Raw rows of each pickup month, stray ones included; ``None`` for those without a time.

    One scan of a single column. There are as many months as the calendar has, not more.
    """
    counted = raw.groupBy(pickup_month(raw).alias("month")).agg(F.count("*").alias("n")).collect()
    return {r["month"] and (r["month"].year, r["month"].month): r["n"] for r in counted}


def batches_of(
    rows: Mapping[Month | None, int], nb_bytes: int, most: int = BYTES_PER_BATCH
) -> Iterator[tuple[list[Month], int]]:
    """Consecutive months of about ``most`` raw bytes together, with those bytes.

    Bytes are dealt to months by their rows. A single larger month is a batch of its own.
    """
    total = max(1, sum(rows.values()))
    batch: list[Month] = []
    size = 0
    for month in sorted(m for m in rows if m is not None):
        own = nb_bytes * rows[month] // total
        if batch and size + own > most:
            yield batch, size
            batch, size = [], 0
        batch.append(month)
        size += own
    yield batch, size


def _days(batch: list[Month]) -> tuple[date, date]:
    (first_year, first), (year, month) = batch[0], batch[-1]
    return date(first_year, first, 1), date(year + month // 12, month % 12 + 1, 1)


def scans_of(trips: DataFrame, batches: list[list[Month]]) -> float:
    """How often all batches together read the rows, if each opens the files that hold one of its months."""
    by_file = trips.groupBy(LANDED_FILE).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(_batch_number(trips, batches)).alias("batches")
    )
    row = by_file.agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("batches")).alias("read")).first()
    return row["read"] / row["rows"] if row["rows"] else 0.0


def _batch_number(raw: DataFrame, batches: list[list[Month]]) -> Column:
    """The batch of a row; null without a pickup time."""
    numbers = {year * 100 + month: n for n, batch in enumerate(batches) for year, month in batch}
    first = pickup_month(raw)
    known = F.create_map(*[F.lit(v) for pair in numbers.items() for v in pair])
    return F.try_element_at(known, F.year(first) * 100 + F.month(first))


def _by_batch(raw: DataFrame, batches: list[list[Month]], folder: str) -> list[DataFrame]:
    """The raw rows of each batch, written in one scan without a shuffle."""
    number = free_name("_batch", raw.columns)
    numbered = raw.withColumn(number, _batch_number(raw, batches)).where(F.col(number).isNotNull())
    numbered.write.partitionBy(number).parquet(folder)
    spark = raw.sparkSession
    return [spark.read.schema(raw.schema).parquet(f"{folder}/{number}={n}") for n in range(len(batches))]


# columns whose bounds the manifest keeps for each file
BOUND_COLUMNS = ("pickup_datetime", "PULocationID", "DOLocationID")


def _clean_batch(
    raw: DataFrame, run: Run, rules: CleaningRules, batch: list[Month], nb_bytes: int
) -> int:
    """Clean some months and write them where the run writes."""
    spark = raw.sparkSession
    trips = picked_up_between(raw, *_days(batch)) if batch else raw.limit(0)
    with session_settings(
        spark, spark__sql__shuffle__partitions=shuffle_partitions_for(spark, nb_bytes)
    ):
        return write_silver(clean(trips, rules), run.folder, replace_all=False).rows


def _publish(raw: DataFrame, run: Run, rules: CleaningRules, months: Iterable[Month] | None) -> int:
    """Publish what the run wrote in place of some months, or of all."""
    spark, schema = raw.sparkSession, clean(raw.limit(0), rules).schema
    files = written_files(spark, run, schema, BOUND_COLUMNS)
    parts = None if months is None else [part_name(year=y, month=m) for y, m in months]
    return publish(spark, run, files, {"": schema}, parts)


def _start(spark: SparkSession, silver: str, replace_all: bool) -> Run:
    if not replace_all and not is_published(spark, silver) and has_files(spark, silver):
        raise ValueError(f"{silver} was written without versions; clean all its months once")
    return start_run(spark, silver)


def run_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    rules: CleaningRules = CleaningRules(),
    replace_all: bool = True,
    batch_bytes: int = BYTES_PER_BATCH,
) -> RunMetrics:
    """Clean all raw trips and publish them, in batches of consecutive months.

    Full rows have to be shuffled to find copies, and a shuffle has as many blocks as map tasks
    times partitions. Copies have equal pickup times, so batches of bounded size give the same
    table. All batches are published together as the next version of the table: a reader sees
    the version before until then, and for good if a batch fails. ``replace_all=False`` keeps the
    months that do not occur in the raw trips. Where pickup times are clustered in raw files, a batch
    skips the row groups of other months; where they are not, so that the batches would read the
    rows more than a few times, the rows are dealt to the batches in a scan before.
    """
    raw = read_bronze(spark, bronze)
    rows = rows_by_month(raw)
    nb_bytes = raw_bytes(spark, bronze)

    def run() -> int:
        begun = _start(spark, silver, replace_all)
        staged = scratch_path(spark, "batches")
        try:
            batches = list(batches_of(rows, nb_bytes, batch_bytes))
            months = [batch for batch, _ in batches]
            parts = [raw] * len(batches)
            if len(batches) > MOST_SCANS and scans_of(trips_by_file(spark, bronze), months) > MOST_SCANS:
                parts = _by_batch(raw, months, staged)
            kept = sum(
                _clean_batch(part, begun, rules, batch, size)
                for part, (batch, size) in zip(parts, batches)
            )
            _publish(raw, begun, rules, None if replace_all else [m for m in rows if m is not None])
        except Exception:
            abandon(spark, begun)
            raise
        finally:
            delete_folder(spark, staged)
        return kept

    return measured("silver", sum(rows.values()), run)


def run_silver_by_month(
    spark: SparkSession,
    bronze: str,
    silver: str,
    months: Iterable[Month],
    rules: CleaningRules = CleaningRules(),
) -> dict[Month, RunMetrics]:
    """Clean some months, one after the other, and replace just these in the clean table.

    They are published together when the last one is clean. A month that has no clean trip any
    more is empty afterwards.
    """
    raw = read_bronze(spark, bronze)
    rows, nb_bytes = rows_by_month(raw), raw_bytes(spark, bronze)
    total = max(1, sum(rows.values()))
    begun, done = _start(spark, silver, False), {}
    try:
        for month in dict.fromkeys(months):
            size = nb_bytes * rows.get(month, 0) // total
            done[month] = measured(
                "silver",
                rows.get(month, 0),
                lambda: _clean_batch(raw, begun, rules, [month], size),
            )
        _publish(raw, begun, rules, done)
    except Exception:
        abandon(spark, begun)
        raise
    return done


def run_zone_layout(
    spark: SparkSession,
    silver: str,
    months: Iterable[Month] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> int:
    """Publish some months of the clean table, or all, in files of neighbouring zones.

    The rows stay the same. A lookup by zone (``read_silver(..., within=...)``) then opens the few
    files whose bounds hold it. Worth it once a month is complete; returns the rows written.
    """
    if not is_published(spark, silver):
        raise ValueError(f"{silver} was written without versions; clean all its months once")
    wanted = None if months is None else list(months)
    run = start_run(spark, silver)
    trips = read_silver(spark, silver, wanted, version=run.base)
    try:
        rows = write_by_zone(trips, run.folder, rows_per_file)
        files = written_files(spark, run, trips.schema, BOUND_COLUMNS)
        parts = None if wanted is None else [part_name(year=y, month=m) for y, m in wanted]
        publish(spark, run, files, {"": trips.schema}, parts)
    except Exception:
        abandon(spark, run)
        raise
    return rows
