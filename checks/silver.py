"""Sources, cleaning steps and scalar functions of trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.registry import check
from checks.sql import BOUNDS, BRONZE, COMPLETE, MEASURES, MONTH, SILVER
from tripmart.config import SourceSpec, default_sources, scratch_path
from tripmart.functions.labels import category, weekday_label, weekday_position, weekend_label
from tripmart.functions.numeric import positive_ratio
from tripmart.functions.temporal import (
    epoch_seconds,
    is_weekend_day,
    minutes_between,
    period_label,
)
from tripmart.operators import cleaning
from tripmart.plans.runs import record
from tripmart.plans.silver import run_silver, run_silver_by_month, run_zone_layout
from tripmart.sinks.snapshots import changed_parts, manifest
from tripmart.sinks.tables import write_silver
from tripmart.sources.landing import land
from tripmart.sources.trips import read_bronze, read_silver, union_by_name

PLAIN_TO_OFFICIAL = {
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
}


def _written_bronze(spark, sf_dir) -> str:
    path = scratch_path(spark, "bronze")
    official = inputs.bronze_trips(spark, sf_dir).withColumnsRenamed(PLAIN_TO_OFFICIAL)
    official.write.parquet(path)
    return path


@check("bronze_scan", f"WITH {BRONZE} SELECT * FROM bronze")
def bronze_scan(spark, sf_dir):
    return read_bronze(spark, _written_bronze(spark, sf_dir))


@check(
    "bronze_scan_drifting_types",
    f"WITH {BRONZE} SELECT * REPLACE (CASE WHEN payment_type = 1 THEN NULL ELSE tolls_amount END "
    "AS tolls_amount, CAST(passenger_count AS DOUBLE) AS passenger_count) FROM bronze",
)
def bronze_scan_drifting_types(spark, sf_dir):
    """Files with other types and without a column, next to the usual ones."""
    path = scratch_path(spark, "bronze")
    trips = inputs.bronze_trips(spark, sf_dir)
    older = trips.where(F.col("payment_type") == 1).drop("tolls_amount")
    older = older.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    older.withColumnsRenamed(PLAIN_TO_OFFICIAL).write.parquet(path)
    trips.where(F.col("payment_type") != 1).write.mode("append").parquet(path)
    return read_bronze(spark, path)


@check("landed_trips", f"WITH {BRONZE} SELECT * FROM bronze")
def landed_trips(spark, sf_dir):
    taxi = SourceSpec("taxi", _written_bronze(spark, sf_dir), "*.parquet", layout="rows")
    target = scratch_path(spark, "landed")
    others = [s for s in default_sources(scratch_path(spark, "raw")) if s.name != "taxi"]
    land(spark, [taxi, *others], target)
    return read_bronze(spark, f"{target}/taxi")


@check("landed_twice", f"WITH {BRONZE} SELECT * FROM bronze")
def landed_twice(spark, sf_dir):
    """Two folders landed one after the other, the second one twice."""
    trips, target = inputs.bronze_trips(spark, sf_dir), scratch_path(spark, "landed")
    for test in ("payment_type = 1", "payment_type <> 1"):
        folder = scratch_path(spark, "bronze")
        trips.where(test).withColumnsRenamed(PLAIN_TO_OFFICIAL).write.parquet(folder)
        land(spark, [SourceSpec("taxi", folder, "*.parquet", layout="rows")], target)
    land(spark, [SourceSpec("taxi", folder, "*.parquet", layout="rows")], target)
    return read_bronze(spark, f"{target}/taxi")


@check(
    "silver_months_with_different_columns",
    f"WITH {SILVER} SELECT *, CASE WHEN month = 4 THEN 'april' END AS note FROM silver "
    "WHERE month IN (3, 4)",
)
def silver_months_with_different_columns(spark, sf_dir):
    """Months written on different days, one of them with a column more."""
    path, trips = scratch_path(spark, "silver"), inputs.silver_trips(spark, sf_dir)
    write_silver(trips.where("month = 3"), path)
    write_silver(trips.where("month = 4").withColumn("note", F.lit("april")), path, replace_all=False)
    return read_silver(spark, path)


@check("silver_month_emptied", f"WITH {SILVER} SELECT * FROM silver WHERE month <> 5")
def silver_month_emptied(spark, sf_dir):
    """All months cleaned, then the Mays again, when none of their trips is valid any more."""
    silver, bronze = scratch_path(spark, "silver"), _written_bronze(spark, sf_dir)
    run_silver(spark, bronze, silver)
    years = [r[0] for r in read_silver(spark, silver).select("year").distinct().collect()]
    broken = scratch_path(spark, "bronze")
    trips = inputs.bronze_trips(spark, sf_dir).where(F.month("pickup_datetime") == 5)
    trips.withColumn("fare_amount", F.lit(-1.0)).write.parquet(broken)
    run_silver_by_month(spark, broken, silver, [(year, 5) for year in years])
    return read_silver(spark, silver)


_BY_PART = "'year=' || year || '/month=' || month AS part"


def _two_versions(spark, sf_dir) -> str:
    """All months, and then Mays without a valid trip and Junes at a price of 7 only."""
    silver, changed = scratch_path(spark, "silver"), scratch_path(spark, "bronze")
    run_silver(spark, _written_bronze(spark, sf_dir), silver)
    month, trips = F.month("pickup_datetime"), inputs.bronze_trips(spark, sf_dir)
    price = F.when(month == 5, -1.0).otherwise(7.0)
    trips.where(month.isin(5, 6)).withColumn("fare_amount", price).write.parquet(changed)
    run_silver(spark, changed, silver, replace_all=False)
    return silver


# the second version: Mays are gone, Junes are made of the raw trips at the other price
_CHANGED = f"""{SILVER},
changed AS (
  SELECT * REPLACE (7.0e0 AS fare_amount) FROM (SELECT DISTINCT * REPLACE (7.0e0 AS fare_amount) FROM bronze)
  WHERE month(pickup_datetime) = 6
),
june AS (
  SELECT *, {MEASURES}, {MONTH} FROM changed
  WHERE {COMPLETE} AND dropoff_datetime > pickup_datetime AND {' AND '.join(BOUNDS.values())}
),
newer AS (SELECT * FROM silver WHERE month NOT IN (5, 6) UNION ALL SELECT * FROM june)"""


@check("silver_snapshot_newest", f"WITH {_CHANGED} SELECT * FROM newer")
def silver_snapshot_newest(spark, sf_dir):
    return read_silver(spark, _two_versions(spark, sf_dir))


@check("silver_snapshot_as_of", f"WITH {SILVER} SELECT * FROM silver")
def silver_snapshot_as_of(spark, sf_dir):
    """The version before, read after another one was published."""
    return read_silver(spark, _two_versions(spark, sf_dir), version=1)


@check(
    "silver_snapshot_changes",
    f"""WITH {_CHANGED}, old AS (SELECT {_BY_PART}, count(*) AS n FROM silver GROUP BY ALL),
    new AS (SELECT {_BY_PART}, count(*) AS n FROM newer GROUP BY ALL),
    touched AS (SELECT part FROM old WHERE part LIKE '%month=5' UNION
      SELECT part FROM new WHERE part LIKE '%month=6' UNION SELECT part FROM old WHERE part LIKE '%month=6')
    SELECT part, CASE WHEN old.n IS NULL THEN 'added' WHEN new.n IS NULL THEN 'removed'
        ELSE 'replaced' END AS change,
      coalesce(old.n, 0) AS rows_before, coalesce(new.n, 0) AS rows_after
    FROM touched LEFT JOIN old USING (part) LEFT JOIN new USING (part)""",
)
def silver_snapshot_changes(spark, sf_dir):
    return changed_parts(spark, _two_versions(spark, sf_dir), 1, 2)


@check(
    "silver_snapshot_manifest",
    f"""WITH {SILVER} SELECT {_BY_PART}, count(*) AS nb_rows,
      epoch_us(min(pickup_datetime)) AS first_pickup, epoch_us(max(pickup_datetime)) AS last_pickup,
      CAST(min(PULocationID) AS BIGINT) AS lowest_zone, CAST(max(PULocationID) AS BIGINT) AS highest_zone,
      count(*) - count(PULocationID) AS without_zone
    FROM silver GROUP BY ALL""",
)
def silver_snapshot_manifest(spark, sf_dir):
    """What the manifest says of the months, without a look at the trips."""
    silver = scratch_path(spark, "silver")
    run_silver(spark, _written_bronze(spark, sf_dir), silver)
    pickup, zone = F.col("bounds")["pickup_datetime"], F.col("bounds")["PULocationID"]
    return manifest(spark, silver).groupBy("part").agg(
        F.sum("nb_rows").alias("nb_rows"),
        F.min(pickup["low"]).alias("first_pickup"),
        F.max(pickup["high"]).alias("last_pickup"),
        F.min(zone["low"]).alias("lowest_zone"),
        F.max(zone["high"]).alias("highest_zone"),
        F.sum(zone["nulls"]).alias("without_zone"),
    )


@check(
    "silver_snapshot_within_bounds",
    f"WITH {SILVER} SELECT * FROM silver WHERE PULocationID BETWEEN 3 AND 5",
)
def silver_snapshot_within_bounds(spark, sf_dir):
    """Trips of a few zones; files whose bounds lie elsewhere are not opened."""
    silver = scratch_path(spark, "silver")
    run_silver(spark, _written_bronze(spark, sf_dir), silver)
    return read_silver(spark, silver, within={"PULocationID": (3, 5)})


@check(
    "silver_zone_lookup",
    f"WITH {SILVER} SELECT * FROM silver WHERE PULocationID BETWEEN 3 AND 4 AND DOLocationID BETWEEN 100 AND 120",
)
def silver_zone_lookup(spark, sf_dir):
    """Trips between some zones, from a table laid out by zone."""
    silver = scratch_path(spark, "silver")
    run_silver(spark, _written_bronze(spark, sf_dir), silver)
    run_zone_layout(spark, silver, rows_per_file=2000)
    return read_silver(spark, silver, within={"PULocationID": (3, 4), "DOLocationID": (100, 120)})


@check("silver_in_batches", f"WITH {SILVER} SELECT * FROM silver")
def silver_in_batches(spark, sf_dir):
    """Many small batches instead of one."""
    silver = scratch_path(spark, "silver")
    run_silver(spark, _written_bronze(spark, sf_dir), silver, batch_bytes=200_000)
    return read_silver(spark, silver)


@check("silver_table_scan", f"WITH {SILVER} SELECT * FROM silver")
def silver_table_scan(spark, sf_dir):
    return inputs.stored_silver(spark, sf_dir)


@check("silver_write_and_read", f"WITH {SILVER} SELECT * FROM silver")
def silver_write_and_read(spark, sf_dir):
    path = scratch_path(spark, "silver")
    write_silver(inputs.silver_trips(spark, sf_dir), path, replace_all=False)
    return read_silver(spark, path)


@check(
    "union_by_name",
    f"""WITH {BRONZE}, both_parts AS (
      SELECT payment_type, trip_distance FROM bronze
      UNION ALL SELECT payment_type, NULL FROM bronze)
    SELECT payment_type, count(*) AS nb_rows, sum(trip_distance) AS distance
    FROM both_parts GROUP BY payment_type""",
)
def union_of_parts(spark, sf_dir):
    trips = inputs.bronze_trips(spark, sf_dir)
    turned = trips.select(*reversed(trips.columns)).drop("trip_distance")
    return (
        union_by_name([trips, turned])
        .groupBy("payment_type")
        .agg(F.count("*").alias("nb_rows"), F.sum("trip_distance").alias("distance"))
    )


@check("trips_renamed", f"WITH {BRONZE} SELECT * FROM bronze")
def trips_renamed(spark, sf_dir):
    official = inputs.bronze_trips(spark, sf_dir).withColumnsRenamed(PLAIN_TO_OFFICIAL)
    return cleaning.rename_present(official)


@check("trips_without_copies", f"WITH {BRONZE} SELECT DISTINCT * FROM bronze")
def trips_without_copies(spark, sf_dir):
    return cleaning.without_copies(inputs.bronze_trips(spark, sf_dir))


@check("trips_with_required", f"WITH {BRONZE} SELECT * FROM bronze WHERE {COMPLETE}")
def trips_with_required(spark, sf_dir):
    return cleaning.with_required(inputs.bronze_trips(spark, sf_dir))


@check(
    "trips_with_types",
    f"""WITH {BRONZE} SELECT * REPLACE (
      TRY_CAST(CASE WHEN payment_type = 3 THEN 'n/a' ELSE CAST(passenger_count AS VARCHAR) END
               AS INTEGER) AS passenger_count)
    FROM bronze""",
)
def trips_with_types(spark, sf_dir):
    """A text column with values that are no numbers; those become null."""
    text = F.when(F.col("payment_type") == 3, "n/a").otherwise(
        F.col("passenger_count").cast("string")
    )
    trips = inputs.bronze_trips(spark, sf_dir).withColumn("passenger_count", text)
    return cleaning.with_types(trips)


@check(
    "trips_in_time_order",
    f"WITH {BRONZE} SELECT * FROM bronze WHERE dropoff_datetime > pickup_datetime",
)
def trips_in_time_order(spark, sf_dir):
    return cleaning.in_time_order(inputs.bronze_trips(spark, sf_dir))


@check("trips_with_measures", f"WITH {BRONZE} SELECT *, {MEASURES} FROM bronze")
def trips_with_measures(spark, sf_dir):
    return cleaning.with_trip_measures(inputs.bronze_trips(spark, sf_dir))


@check(
    "trips_within_bounds",
    f"WITH {BRONZE} SELECT *, {MEASURES} FROM bronze WHERE {' AND '.join(BOUNDS.values())}",
)
def trips_within_bounds(spark, sf_dir):
    measured = cleaning.with_trip_measures(inputs.bronze_trips(spark, sf_dir))
    return cleaning.within_bounds(measured)


@check("trips_with_month", f"WITH {BRONZE} SELECT *, {MONTH} FROM bronze")
def trips_with_month(spark, sf_dir):
    return cleaning.with_month(inputs.bronze_trips(spark, sf_dir))


@check("silver_clean", f"WITH {SILVER} SELECT * FROM silver")
def silver_clean(spark, sf_dir):
    return inputs.silver_trips(spark, sf_dir)


REASON = (
    f"CASE WHEN NOT ({COMPLETE}) THEN 'missing_value' "
    "WHEN NOT dropoff_datetime > pickup_datetime THEN 'not_in_time_order' "
    + " ".join(f"WHEN NOT ({test}) THEN '{name}'" for name, test in BOUNDS.items())
    + " ELSE 'rows_out' END"
)


@check(
    "silver_row_accounting",
    f"""WITH {BRONZE}, unique_rows AS (SELECT DISTINCT * FROM bronze)
    SELECT 'rows_in' AS step, count(*) AS nb_rows FROM bronze
    UNION ALL SELECT 'duplicate', (SELECT count(*) FROM bronze) - count(*) FROM unique_rows
    UNION ALL
    SELECT step, count(reason)
    FROM (SELECT unnest(['missing_value', 'not_in_time_order', {', '.join(f"'{b}'" for b in BOUNDS)},
                         'rows_out']) AS step)
    LEFT JOIN (SELECT {REASON} AS reason FROM unique_rows) ON reason = step
    GROUP BY step""",
)
def silver_row_accounting(spark, sf_dir):
    return cleaning.row_accounting(inputs.bronze_trips(spark, sf_dir))


@check(
    "silver_job_counts",
    f"""WITH {SILVER}, counts AS (
      SELECT (SELECT count(*) FROM bronze) AS rows_in, (SELECT count(*) FROM silver) AS rows_out)
    SELECT 'silver' AS job, rows_in, rows_out, rows_in - rows_out AS rows_rejected FROM counts""",
)
def silver_job_counts(spark, sf_dir):
    """The job from raw files to the clean table, and what it put on record."""
    silver, runs = scratch_path(spark, "silver"), scratch_path(spark, "runs")
    record(spark, run_silver(spark, _written_bronze(spark, sf_dir), silver), runs)
    return spark.read.parquet(runs).select("job", "rows_in", "rows_out", "rows_rejected")


# scalar functions, on all orders, events or trips


@check(
    "time_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
      CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
      dayofweek(ts) IN (0, 6) AS weekend, CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
      CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
      CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS period
    FROM events""",
)
def time_parts(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    day = F.dayofweek(ts)
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        F.hour(ts).alias("hour"),
        day.alias("day_of_week"),
        is_weekend_day(day).alias("weekend"),
        epoch_seconds(F.col("ts")).alias("seconds"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.to_date(ts).alias("day"),
        period_label(F.year(ts), F.month(ts)).alias("period"),
    )


@check(
    "minutes_between",
    """SELECT event_id,
      (floor(epoch(ts)) - floor(epoch(date_trunc('day', ts)))) / 60.0e0 AS minutes
    FROM events""",
)
def elapsed_minutes(spark, sf_dir):
    start = F.date_trunc("day", F.col("ts").cast("timestamp"))
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", minutes_between(start, F.col("ts")).alias("minutes")
    )


@check(
    "guarded_ratio",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_tax > 0 THEN l_extendedprice / l_tax END AS ratio FROM lineitem""",
)
def guarded_ratio(spark, sf_dir):
    ratio = positive_ratio(F.col("l_extendedprice"), F.col("l_tax"))
    return inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", ratio.alias("ratio")
    )


@check(
    "display_labels",
    """SELECT o_orderkey, o_custkey % 9 AS code,
      CASE o_custkey % 9 WHEN 1 THEN 'Dim' WHEN 2 THEN 'Lun' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Mer'
        WHEN 5 THEN 'Jeu' WHEN 6 THEN 'Ven' WHEN 7 THEN 'Sam' END AS day_label,
      CAST(CASE WHEN o_custkey % 9 BETWEEN 2 AND 7 THEN o_custkey % 9 - 2
        WHEN o_custkey % 9 = 1 THEN 6 END AS INTEGER) AS position,
      CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 'Week-end'
        ELSE 'Semaine' END AS part,
      CAST(o_custkey AS VARCHAR) AS customer
    FROM orders""",
)
def display_labels(spark, sf_dir):
    """Labels of codes; a code that is no day, or an unknown flag, has none."""
    code = F.col("o_custkey") % 9
    day = code.cast("int")
    flag = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        code.alias("code"),
        weekday_label(day).alias("day_label"),
        weekday_position(day).alias("position"),
        weekend_label(flag).alias("part"),
        category(F.col("o_custkey")).alias("customer"),
    )
