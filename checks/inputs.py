"""Inputs of the queries: trips, weather, news and metric samples derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import scratch_path, use_utc
from tripmart.operators.cleaning import clean
from tripmart.schema import SILVER_PARTITIONS
from tripmart.sinks.tables import write_silver
from tripmart.sources.trips import read_silver


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _sixtyfourths(amount):
    """Rounded down to 1/64, so that sums are exact in any order."""
    return F.floor(amount * 64.0) / 64.0


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips from all of ``lineitem``; some rows come twice, as in files landed twice."""
    items = table(spark, sf_dir, "lineitem")
    start = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 1440
    length = F.col("l_partkey") % 200 - 5
    price = F.col("l_extendedprice") / 200.0
    copies = F.when(F.col("l_orderkey") % 50 == 0, 2).otherwise(1)

    def after(minutes):
        return F.col("l_shipdate") + F.make_dt_interval(mins=minutes.cast("int"))

    def known_unless(code, value):
        return F.when(F.col("l_partkey") % code != 0, value)

    trips = items.select(
        after(start).alias("pickup_datetime"),
        after(start + length).alias("dropoff_datetime"),
        (F.col("l_quantity") / 4.0).alias("trip_distance"),
        F.col("l_linenumber").alias("passenger_count"),
        (_sixtyfourths(price) - 10.0).alias("fare_amount"),
        known_unless(89, _sixtyfourths(price * F.col("l_discount"))).alias("tip_amount"),
        F.floor(F.col("l_tax") * 100.0 + 0.5).cast("double").alias("tolls_amount"),
        known_unless(97, _sixtyfourths(price * (F.col("l_tax") + 1.0))).alias("total_amount"),
        F.when(F.col("l_returnflag") == "A", 1)
        .when(F.col("l_returnflag") == "N", 2)
        .otherwise(3)
        .cast("bigint")
        .alias("payment_type"),
        known_unless(101, F.col("l_suppkey")).alias("PULocationID"),
        (F.col("l_partkey") % 265).alias("DOLocationID"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    )
    return trips.drop("copy")


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips as one lazy plan over ``lineitem``."""
    return clean(bronze_trips(spark, sf_dir))


_stored: dict[tuple[str, str], str] = {}


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips from a table written once per session, for operators that scan repeatedly."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = scratch_path(spark, "silver")
        write_silver(clean(bronze_trips(spark, sf_dir), by_time=True), path, gathered=True)
        _stored[key] = path
    return read_silver(spark, _stored[key])


def write_months(trips: DataFrame, path: str) -> None:
    """Trips of a table by month as another one; its files hold a month each, so no row has to move."""
    trips.write.partitionBy(*SILVER_PARTITIONS).parquet(path)


def weather_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly values from all of ``orders``, in the range of days that trips have."""
    orders = table(spark, sf_dir, "orders")
    hour = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return orders.groupBy(hour.alias("hour")).agg(
        F.max(F.floor(F.col("o_totalprice") / 10000.0)).cast("double").alias("temperature_2m"),
        (F.count("*") / 4.0).alias("precipitation"),
        F.min(F.col("o_custkey") % 100).cast("double").alias("relative_humidity_2m"),
        F.max(F.col("o_custkey") % 30).cast("double").alias("wind_speed_10m"),
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values as a document per month, with arrays of 31 times 24 entries at most."""
    hours = weather_hours(spark, sf_dir)
    values = [name for name in hours.columns if name != "hour"]
    entry = F.struct(
        F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), *[F.col(v) for v in values]
    )
    months = hours.groupBy(F.date_trunc("month", "hour").alias("month")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    arrays = [F.col("entries")[name].alias(name) for name in ("time", *values)]
    return months.select(
        F.lit("America/New_York").alias("timezone"), F.struct(*arrays).alias("hourly")
    )


def news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items from all of ``pages``."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    published = start + F.make_dt_interval(mins=F.col("page_id").cast("int"))
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("Page "), F.col("page_id")).alias("title"),
        F.col("url").alias("link"),
        F.concat(F.date_format(published, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias(
            "pubDate"
        ),
        F.struct(
            F.concat(F.lit("Source "), F.col("page_id") % 7).alias("_VALUE"),
            F.concat(F.lit("http://example.com/"), F.col("page_id") % 7).alias("_url"),
        ).alias("source"),
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host metrics from all of ``events``: each event is a scrape of one host.

    Counters start over every few hundred scrapes, and one of them resets all the time.
    """
    scrape = F.col("event_id")
    gauge = _sixtyfourths(F.col("value"))
    host = F.concat(F.lit("host-"), F.col("user_id") % 2)

    def sample(metric, value, **labels):
        pairs = [F.lit("instance"), F.col("host")]
        pairs += [F.lit(part) for pair in labels.items() for part in pair]
        return F.struct(
            F.lit(metric).alias("metric"),
            F.create_map(*pairs).alias("labels"),
            value.cast("double").alias("value"),
        )

    def counter(step, size, scale):
        return scrape * step % size * scale

    samples = [
        sample("node_cpu_seconds_total", counter(1, 500, 0.75), cpu="0", mode="idle"),
        sample("node_cpu_seconds_total", counter(1, 300, 0.5), cpu="1", mode="idle"),
        sample("node_cpu_seconds_total", gauge, cpu="0", mode="user"),
        sample("node_memory_MemAvailable_bytes", gauge),
        sample("node_memory_MemTotal_bytes", F.lit(512.0)),
        sample("node_filesystem_avail_bytes", gauge, mountpoint="/", fstype="ext4"),
        sample("node_filesystem_size_bytes", F.lit(1024.0), mountpoint="/", fstype="ext4"),
        sample("node_filesystem_avail_bytes", gauge, mountpoint="/run", fstype="tmpfs"),
        sample("node_filesystem_size_bytes", F.lit(512.0), mountpoint="/run", fstype="tmpfs"),
        sample("node_disk_read_bytes_total", counter(3, 1000, 512.0), device="sda"),
        sample("node_disk_written_bytes_total", counter(7, 1000, 512.0), device="sda"),
        sample("node_network_receive_bytes_total", counter(5, 2000, 64.0), device="eth0"),
        sample("node_network_transmit_bytes_total", counter(9, 2000, 64.0), device="eth0"),
        sample("node_network_receive_bytes_total", counter(5, 2000, 32.0), device="lo"),
        sample("node_network_transmit_bytes_total", counter(9, 2000, 32.0), device="lo"),
        sample("node_load1", gauge / 64.0),
        sample("node_load5", gauge / 128.0),
        sample("node_load15", gauge / 256.0),
    ]
    return (
        table(spark, sf_dir, "events")
        .withColumn("host", host)
        .select(F.col("ts").cast("timestamp").alias("ts"), F.inline(F.array(*samples)))
    )
