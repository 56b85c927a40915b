"""Metric samples that arrive late, settled in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import session_settings, use_utc
from tripmart.operators.counters import counter_rate
from tripmart.schema import METRIC_SAMPLES
from tripmart.sinks.snapshots import has_files
from tripmart.streaming.copies import STATE_STORE
from tripmart.streaming.landing import ANY_AGE

DELAY = "1 hour"
_SETTLED = "metric string, labels map<string, string>, ts timestamp, low double, high double"


def stamped(samples: DataFrame) -> DataFrame:
    """What is known of a series at one time stamp: its lowest and highest value.

    Partials of a stamp are merged by minimum and maximum, so it does not matter in how many parts,
    in which order or how often its samples arrive. The labels are part of the key as sorted entries,
    since maps cannot be grouped.
    """
    entries = F.array_sort(F.map_entries("labels"))
    return samples.where(F.col("value").isNotNull()).groupBy("metric", entries.alias("entries"), "ts").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )


def settle_samples(
    spark: SparkSession, folder: str, table: str, checkpoint: str, delay: str = DELAY, files_per_batch: int = 1000
) -> int:
    """Add the stamps that have become final since the last run; returns how many samples came too late.

    A stamp is final when the newest sample is ``delay`` younger. Until then it is one row of the
    state, which holds no more than the stamps of that time.
    """
    use_utc(spark)
    samples = (
        spark.readStream.schema(METRIC_SAMPLES)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .parquet(folder)
    )
    settled = stamped(samples.withWatermark("ts", delay)).select(
        "metric", F.map_from_entries("entries").alias("labels"), "ts", "low", "high"
    )

    def append(batch: DataFrame, number: int) -> None:
        day = F.to_date("ts").alias("day")
        batch.select("*", day).write.mode("overwrite").partitionBy("day").parquet(f"{table}/batch={number}")

    settings = {
        "spark__sql__streaming__stateStore__providerClass": STATE_STORE,
        "spark__sql__streaming__numRecentProgressUpdates": 100_000,
    }
    with session_settings(spark, **settings):
        writer = settled.writeStream.outputMode("append").foreachBatch(append)
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def settled_samples(spark: SparkSession, table: str) -> DataFrame:
    """The final stamps as samples again: the lowest value of a stamp, and the highest if it is another."""
    if not has_files(spark, table):
        return spark.createDataFrame([], METRIC_SAMPLES)
    rows = spark.read.schema(f"{_SETTLED}, batch bigint, day date").parquet(table)
    values = F.when(F.col("low") < F.col("high"), F.array("low", "high")).otherwise(F.array("low"))
    return rows.select("ts", "metric", "labels", F.explode(values).alias("value"))


def counter_rates_so_far(spark: SparkSession, table: str, labels: tuple[str, ...]) -> DataFrame:
    """``counter_rate`` at all final stamps."""
    return counter_rate(settled_samples(spark, table), labels)
