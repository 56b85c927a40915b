"""Removal of copies across runs: rows that came before, in this run or in any earlier one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import session_settings, use_utc
from tripmart.operators.cleaning import rename_present
from tripmart.sinks.snapshots import delete_folder, has_files, mean_file_bytes
from tripmart.sources.trips import LANDED_FILE
from tripmart.streaming.landing import ANY_AGE

KEYS = ("content_a", "content_b")
ARRIVED = "arrived_at"  # the event time: when the trip began, as a time with a zone
MONTH = "pickup_month"
FILE = "__file"
DELAY = "45 days"
# bytes of files in a batch of the stream and rows in a comparison of late ones, so that neither the
# state nor a shuffle grows with all that was landed
BATCH_BYTES = 512 << 20
COMPARED_ROWS = 16_000_000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class UniqueRun:
    """What a run read and added. Late rows came after the watermark had passed their time."""

    rows_in: int
    rows_out: int
    late_rows: int
    recovered_rows: int
    rows_in_state: int

    @property
    def copies(self) -> int:
        return self.rows_in - self.rows_out


def with_content_keys(rows: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """128 bits that are equal for rows equal in ``names``, by default all columns; a null equals a null only."""
    names = sorted(rows.columns if names is None else names)
    values = [c for name in names for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return rows.withColumns({key: F.xxhash64(F.lit(salt), *values) for salt, key in enumerate(KEYS)})


def _pickup_time(rows: DataFrame) -> Column:
    pickup = F.col("pickup_datetime")
    if isinstance(rows.schema["pickup_datetime"].dataType, T.StringType):
        return pickup.try_cast("timestamp")
    return pickup.cast("timestamp")


def _plain(raw: DataFrame) -> DataFrame:
    """What the table keeps of raw rows: all but the file they came from and its own columns."""
    return rename_present(raw).drop(LANDED_FILE, *KEYS, ARRIVED, MONTH)


def _keyed(raw: DataFrame) -> DataFrame:
    """Raw rows with their keys and event time; a row without a time is no trip and is left out.

    From which file a row came makes no difference between copies.
    """
    rows = with_content_keys(_plain(raw))
    return rows.withColumn(ARRIVED, _pickup_time(rows)).where(F.col(ARRIVED).isNotNull())


def _month() -> Column:
    return F.year(ARRIVED) * 100 + F.month(ARRIVED)


def without_copies_in_stream(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """The rows of a stream, each once, with keys and event time.

    The state holds 16 bytes and a time for each row, not its columns. The watermark is the newest
    pickup less ``delay``; a key is forgotten when it has passed the pickup by ``delay``, so the state
    spans twice the delay. Copies have equal pickups, hence one that is not late meets its key.
    Late rows are dropped here and counted by the query; :func:`unique_trips` brings them back.
    """
    return _keyed(raw).withWatermark(ARRIVED, delay).dropDuplicatesWithinWatermark(list(KEYS))


def _append(rows: DataFrame, table: str, batch: str) -> int:
    """Write a batch under its own name: a batch that is run again replaces itself.

    Keys and event time follow from the row; they are a third of it and hardly compress, so they
    are not written.
    """
    seen = Observation(f"unique-{batch}")
    counted = rows.withColumn(MONTH, _month()).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.drop(*KEYS, ARRIVED).write.mode("overwrite").option("compression", "zstd")
    writer.partitionBy(MONTH).parquet(f"{table}/rows/batch={batch}")
    return seen.get["rows"]


def read_unique(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Raw trips without copies, under their plain column names, with ``content_a``, ``content_b``,
    ``arrived_at`` and ``pickup_month``; all but the month are worked out where they are asked for."""
    plain = _plain(spark.createDataFrame([], schema)).schema
    own = T.StructType([*plain, T.StructField(MONTH, T.IntegerType())])
    path = f"{table.rstrip('/')}/rows"
    if has_files(spark, path):
        stored = spark.read.schema(own).option("basePath", path).parquet(path).select(*own.names)
    else:
        stored = spark.createDataFrame([], own)
    rows = with_content_keys(stored, plain.names)
    return rows.withColumn(ARRIVED, _pickup_time(rows)).select(*plain.names, *KEYS, ARRIVED, MONTH)


def _month_groups(counts: Sequence[tuple[int, int]], limit: int) -> list[list[int]]:
    """Consecutive months with at most ``limit`` rows together; a larger month is alone."""
    groups: list[list[int]] = []
    held = 0
    for month, rows in sorted(counts):
        if not groups or held + rows > limit:
            groups.append([])
            held = 0
        groups[-1].append(month)
        held += rows
    return groups


def recover(
    spark: SparkSession,
    raw: DataFrame,
    table: str,
    schema: T.StructType,
    until: Column | None = None,
    rows_at_once: int = COMPARED_ROWS,
) -> int:
    """Add the rows that the table lacks, of those with a pickup of ``until`` or before.

    Only the months in which ``raw`` has such rows are compared. Copies have equal pickups, so a few
    months at a time are, and what is shuffled at once grows neither with ``raw`` nor with the table.
    """
    keyed = _keyed(raw)
    if until is not None:
        keyed = keyed.where(F.col(ARRIVED) <= until)
    # as many months as the calendar has; of known rows only the keys are shuffled, so they count half
    counts = dict(keyed.groupBy(_month().alias(MONTH)).count().collect())
    unique = read_unique(spark, table, schema)
    for month, rows in unique.where(F.col(MONTH).isin([*counts])).groupBy(MONTH).count().collect():
        counts[month] += rows // 2
    added = 0
    for months in _month_groups([*counts.items()], rows_at_once):
        known = read_unique(spark, table, schema).where(F.col(MONTH).isin(months)).select(*KEYS)
        own = keyed.where(_month().isin(months))
        # both are dealt by the keys, so the rows are shuffled once; most are known and need not be told apart
        lacking = own.join(known, list(KEYS), "left_anti").dropDuplicates(list(KEYS))
        added += _append(lacking, table, f"late-{uuid.uuid4().hex}")
    return added


def _mark(spark: SparkSession, place: str, at: datetime | None = None) -> None:
    """Keep a time, by default now, in a folder."""
    value = F.current_timestamp() if at is None else F.lit(at)
    spark.range(1).select(value.alias("at")).coalesce(1).write.mode("overwrite").parquet(place)


def _marked(spark: SparkSession, place: str) -> datetime | None:
    if not has_files(spark, place):
        return None
    row = spark.read.schema("at timestamp").parquet(place).first()
    return row and row["at"]


def unique_trips(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    delay: str = DELAY,
    files_per_batch: int = 1000,
    bytes_per_batch: int = BATCH_BYTES,
) -> UniqueRun:
    """Add the rows that were landed since the last run to the table of rows without copies.

    On-time rows go through the state store, in batches of at most ``files_per_batch`` files or, where
    so many would be more, ``bytes_per_batch``. The files of a batch in which rows came late are looked
    at once more: rows up to its watermark whose keys the table lacks are added by a join over their
    months. So the table is that of a ``distinct`` over everything landed, however late a row is. A run that was
    stopped between the two has left the folder ``open`` behind, and the next one looks at all files
    since the start of the last run that finished.

    Shuffles and states of batches that are done are deleted while the run goes on.
    """
    use_utc(spark)
    table, landed = table.rstrip("/"), landed.rstrip("/")
    opened, finished = f"{table}/open", f"{table}/finished"
    interrupted = has_files(spark, opened)
    if not interrupted:
        _mark(spark, opened)
    since = _marked(spark, finished)  # files of the time before were all looked at
    began = _marked(spark, opened)

    # the source takes one bound only
    small = mean_file_bytes(spark, landed) * files_per_batch <= bytes_per_batch
    bound = {"maxFilesPerTrigger": files_per_batch} if small else {"maxBytesPerTrigger": bytes_per_batch}
    raw = spark.readStream.schema(schema).options(**bound).option("maxFileAge", ANY_AGE).parquet(landed)
    seen = raw.withColumn(FILE, F.col("_metadata.file_path")).observe(
        "arrived", F.count(F.lit(1)).alias("rows"), F.collect_set(FILE).alias("files")
    )
    unique = without_copies_in_stream(seen.drop(FILE), delay)
    added: dict[int, int] = {}

    def append(batch: DataFrame, number: int) -> None:
        added[number] = _append(batch, table, str(number))

    settings = {
        "spark__sql__streaming__stateStore__providerClass": STATE_STORE,
        "spark__sql__streaming__numRecentProgressUpdates": 100_000,
        # a run goes on from the last state only, and forgotten keys need no room in it
        "spark__sql__streaming__minBatchesToRetain": 2,
        "spark__sql__streaming__stateStore__rocksdb__compactOnCommit": "true",
        "spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true",
    }
    rows_in = late = state = recovered = 0
    files: set[str] = set()
    passed: set[str] = set()
    landed_rows = spark.read.schema(schema)
    with session_settings(spark, **settings):
        writer = unique.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        for progress in query.recentProgress:
            dropped = sum(store.numRowsDroppedByWatermark for store in progress.stateOperators)
            late += dropped
            state = sum(store.numRowsTotal for store in progress.stateOperators)
            if dropped:
                passed.add(progress.eventTime["watermark"])
            arrived = progress.observedMetrics.get("arrived")
            if arrived is not None:
                rows_in += arrived["rows"]
                files.update(arrived["files"] if dropped else [])
        if interrupted:
            again = landed_rows.parquet(landed)
            if since is not None:
                again = again.where(F.col("_metadata.file_modification_time") >= F.lit(since))
            recovered = recover(spark, again, table, schema)
        elif files:
            again = landed_rows.option("basePath", landed).parquet(*sorted(files))
            until = F.array_max(F.array(*[F.lit(at).cast("timestamp") for at in passed]))
            recovered = recover(spark, again, table, schema, until)
    _mark(spark, finished, began)
    delete_folder(spark, opened)
    return UniqueRun(rows_in, sum(added.values()) + recovered, late, recovered, state)
