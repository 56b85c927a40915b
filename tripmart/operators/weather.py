"""Hourly weather: from parallel arrays to rows, and from there onto the trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import use_utc
from tripmart.functions.columns import free_name
from tripmart.operators.profiling import correlation_matrix
from tripmart.schema import WEATHER_VARIABLES

MOST_DOUBLINGS = 30  # of a step in an array, so that any length an array can have is covered


def unzip_arrays(df: DataFrame, arrays: dict[str, Column], *keep: str) -> DataFrame:
    """One row per position of parallel arrays, with that ``position``.

    A missing array counts as empty and a short one is filled up with nulls.
    """
    padded = [F.coalesce(column, F.array()).alias(name) for name, column in arrays.items()]
    zipped = df.select(*keep, *padded).select(*keep, F.arrays_zip(*arrays).alias("zipped"))
    return zipped.select(*keep, F.posexplode("zipped").alias("position", "entry")).select(
        *keep, "position", *[F.col("entry")[name].alias(name) for name in arrays]
    )


def hourly_weather(raw: DataFrame) -> DataFrame:
    """Weather files to one row per hour.

    Times are wall-clock hours of the place, as those of the trips are, so they are compared
    without any zone shift. Where an hour occurs more than once (clock change, overlapping
    files), the file retrieved last counts, of files without a stamp or with the same one the one
    whose name comes last, and in a file the first entry.
    """
    use_utc(raw.sparkSession)
    if "fetched_at" not in raw.columns:
        raw = raw.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    if "file_name" not in raw.columns:
        raw = raw.withColumn("file_name", F.lit(None).cast("string"))
    arrays = {name: F.col("hourly")[name] for name in ("time", *WEATHER_VARIABLES)}
    hour = F.date_trunc("hour", F.try_to_timestamp("time", F.lit("yyyy-MM-dd'T'HH:mm")))
    values = F.struct(*WEATHER_VARIABLES)
    age = F.struct(
        F.coalesce(F.unix_seconds("fetched_at"), F.lit(0)).alias("fetched"),
        F.coalesce("file_name", F.lit("")).alias("file"),
        (-F.col("position")).alias("place"),
        F.coalesce(F.to_json(values), F.lit("")).alias("content"),
    )
    return (
        unzip_arrays(raw, arrays, "fetched_at", "file_name")
        .withColumn("weather_hour", hour)
        .where(F.col("weather_hour").isNotNull())
        .groupBy("weather_hour")
        .agg(F.max_by(values, age).alias("w"))
        .select("weather_hour", *[F.col("w")[name].alias(name) for name in WEATHER_VARIABLES])
    )


def with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips with the weather of their pickup hour; every trip is kept, once.

    Adaptive execution knows the size of the weather when it joins: it broadcasts a small side,
    else shuffles both and splits hours that hold many trips.
    """
    hour = F.date_trunc("hour", F.col("pickup_datetime").cast("timestamp"))
    joined = trips.withColumn("weather_hour", hour).join(weather, "weather_hour", "left")
    return joined.select(*trips.columns, "weather_hour", *WEATHER_VARIABLES)


def with_latest_weather(
    trips: DataFrame,
    readings: DataFrame,
    tolerance: int = 3 * 3600,
    bucket: int = 6 * 3600,
    variables: tuple[str, ...] = WEATHER_VARIABLES,
    time_col: str = "weather_hour",
) -> DataFrame:
    """Trips with the last reading at or before their pickup, if not older than ``tolerance`` seconds.

    ``readings`` may come at any times, in ``time_col``; of equal times the greatest row counts. Both
    sides are dealt to buckets of time, a reading to all that it can still be valid in, so the equal
    join by bucket finds all there is. The readings of a bucket are one row with a sorted array,
    bounded by the bucket, in which each trip looks its own one up by halving it: trips are neither
    windowed nor compared in pairs or with all readings of a bucket, and adaptive execution broadcasts the buckets or splits the ones with many
    trips. Every trip is kept, once; without a reading, or without a pickup, the weather and
    ``weather_time`` are null.
    """
    use_utc(trips.sparkSession)
    bucket_col, readings_col, found_col = (
        free_name(name, trips.columns) for name in ("_bucket", "_readings", "_found")
    )
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    first = F.floor(at / (bucket * 1_000_000)).cast("bigint")
    last = F.floor((at + tolerance * 1_000_000) / (bucket * 1_000_000)).cast("bigint")
    entry = F.struct(at.alias("at"), *[F.col(v).alias(v) for v in variables])
    buckets = (
        readings.where(F.col(time_col).isNotNull())
        .select(entry.alias("reading"), F.explode(F.sequence(first, last)).alias(bucket_col))
        .groupBy(bucket_col, "reading.at")
        .agg(F.max("reading").alias("reading"))
        .groupBy(bucket_col)
        .agg(F.array_sort(F.collect_list("reading")).alias(readings_col))
    )
    pickup = F.unix_micros(F.col("pickup_datetime").cast("timestamp"))
    own_bucket = F.floor(pickup / (bucket * 1_000_000)).cast("bigint")
    joined = trips.withColumn(bucket_col, own_bucket).join(buckets, bucket_col, "left")
    # how many readings of the bucket are not after the pickup; 0 where there is none of either
    until = F.aggregate(
        F.array(*[F.lit(2**k) for k in reversed(range(MOST_DOUBLINGS))]),
        F.lit(0),
        lambda seen, step: F.when(
            (seen + step <= F.size(readings_col)) & (F.get(readings_col, seen + step - 1)["at"] <= pickup), seen + step
        ).otherwise(seen),
    )
    last_one = joined.withColumn(found_col, F.get(readings_col, until - 1)).drop(readings_col)
    valid = F.col(found_col)["at"] >= pickup - tolerance * 1_000_000
    found = last_one.withColumn(found_col, F.when(valid, F.col(found_col)))
    return found.select(
        *trips.columns,
        F.timestamp_micros(F.col(found_col)["at"]).alias("weather_time"),
        *[F.col(found_col)[v].alias(v) for v in variables],
    )


def weather_correlations(
    trips: DataFrame,
    weather: DataFrame,
    price: str = "total_amount",
    variables: tuple[str, ...] = ("precipitation", "temperature_2m"),
) -> DataFrame:
    """Correlation of the price with weather variables, as ``(x, y, r)``."""
    enriched = with_weather(trips, weather).select(price, *variables)
    pairs = correlation_matrix(enriched, (price, *variables))
    return pairs.where((F.col("x") == price) & (F.col("y") != price))
