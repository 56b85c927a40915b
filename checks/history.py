"""Jobs that go on from earlier runs: landing, removal of copies, sketches by month; and rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.registry import check
from checks.silver import PLAIN_TO_OFFICIAL, REASON
from checks.sql import BRONZE, COMPLETE, SILVER
from tripmart.config import CleaningRules, SourceSpec, scratch_path
from tripmart.functions.numeric import present
from tripmart.operators import rejects, sketches
from tripmart.operators.cleaning import clean
from tripmart.operators.profiling import NUMERIC_COLUMNS, QUARTILES
from tripmart.plans.gold import refresh_sketches
from tripmart.sinks.tables import write_silver
from tripmart.sources.trips import read_bronze, read_silver
from tripmart.streaming.copies import read_unique, unique_trips
from tripmart.streaming.landing import land_new, landed_files


def _append(trips, folder: str) -> None:
    trips.withColumnsRenamed(PLAIN_TO_OFFICIAL).write.mode("append").parquet(folder)


@check("landed_incrementally", f"WITH {BRONZE} SELECT * FROM bronze")
def landed_incrementally(spark, sf_dir):
    """Files of one payment type, then those of the others, then none."""
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("raw", "landed", "checkpoint"))
    sources = [SourceSpec("taxi", folder, "*.parquet", layout="rows")]
    trips = inputs.bronze_trips(spark, sf_dir)
    for test in ("payment_type = 1", "payment_type <> 1"):
        _append(trips.where(test), folder)
        land_new(spark, sources, target, checkpoint)
    land_new(spark, sources, target, checkpoint)
    return read_bronze(spark, f"{target}/taxi")


@check(
    "landed_file_list",
    f"""WITH {BRONZE} SELECT 'taxi' AS source, CAST(b - 1 AS VARCHAR) AS batch, count(*) AS nb_rows
    FROM (SELECT *, payment_type AS b FROM bronze) GROUP BY 2""",
)
def landed_file_list(spark, sf_dir):
    """Rows of the files that each run landed, from the list of landed files."""
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("raw", "landed", "checkpoint"))
    sources = [SourceSpec("taxi", folder, "*.parquet", layout="rows")]
    trips = inputs.bronze_trips(spark, sf_dir)
    for kind in (1, 2, 3):
        _append(trips.where(F.col("payment_type") == kind), folder)
        land_new(spark, sources, target, checkpoint)
    name = F.element_at(F.split("path", "/"), -1)
    listed = landed_files(spark, target).select("source", "batch", name.alias("landed_file"))
    rows = spark.read.parquet(f"{target}/taxi")
    return rows.join(listed, "landed_file").groupBy("source", "batch").agg(F.count("*").alias("nb_rows"))


def _fed_in_three_parts(spark, sf_dir):
    """Trips of the first years, of the years after with copies of the first ones, and late ones."""
    folder, table, checkpoint = (scratch_path(spark, n) for n in ("landed", "unique", "checkpoint"))
    trips = inputs.bronze_trips(spark, sf_dir)
    year, late = F.year("pickup_datetime"), F.col("DOLocationID") % 7 == 0
    parts = [
        trips.where((year <= 1995) & ~late),
        trips.where((year > 1995) | (F.col("DOLocationID") % 5 == 0) & ~late),
        trips.where((year <= 1995) & late).unionAll(trips.where("DOLocationID % 11 = 0")),
    ]
    runs = []
    for part in parts:
        part.write.mode("append").parquet(folder)
        runs.append(unique_trips(spark, folder, trips.schema, table, checkpoint))
    return read_unique(spark, table, trips.schema).select(*trips.columns), runs


@check("trips_without_copies_across_runs", f"WITH {BRONZE} SELECT DISTINCT * FROM bronze")
def trips_without_copies_across_runs(spark, sf_dir):
    return _fed_in_three_parts(spark, sf_dir)[0]


def _stored_sketches(spark, sf_dir):
    """Sketches of all months with the Aprils wrong, and then the Aprils alone once more."""
    old, silver, stored = (scratch_path(spark, n) for n in ("silver", "silver", "sketches"))
    write_silver(clean(inputs.bronze_trips(spark, sf_dir), by_time=True), silver, True, True)
    trips = read_silver(spark, silver)  # cleaned once
    inputs.write_months(trips.where("month <> 4 OR PULocationID > 5"), old)
    refresh_sketches(spark, old, stored)
    years = [r[0] for r in trips.select("year").distinct().collect()]
    refresh_sketches(spark, silver, stored, [(y, 4) for y in years])
    return spark.read.parquet(stored), trips


@check(
    "sketched_quantiles",
    f"WITH {SILVER} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST({q} AS DOUBLE) AS rank, count({c}) AS nb_values, true AS in_bound FROM silver"
        for c in NUMERIC_COLUMNS
        for q in QUARTILES
    ),
)
def sketched_quantiles(spark, sf_dir):
    """Quartiles from the merged sketches of all months; their ranks are counted in the trips.

    The stated error holds in 99 of 100 cases, so twice of it is what is looked at here.
    """
    cells, silver = _stored_sketches(spark, sf_dir)
    found = sketches.sketched_quantiles(cells).collect()  # a row a column and rank

    def counts(row):
        v, value = present(F.col(row["column"]).cast("double")), F.lit(row["value"]).cast("double")
        return F.struct(
            *[F.lit(row[c]).alias(c) for c in ("column", "rank", "nb_values", "rank_error")],
            F.try_divide(F.count_if(v < value), F.count(v)).alias("below"),
            F.try_divide(F.count_if(v <= value), F.count(v)).alias("up_to"),
        )

    if not found:
        return spark.createDataFrame([], "column string, rank double, nb_values bigint, in_bound boolean")
    # one scan that keeps a row a task
    all_counts = silver.agg(F.array(*map(counts, found)).alias("counts"))
    counted = all_counts.select(F.inline("counts")).where("below IS NOT NULL")
    slack = 2 * F.col("rank_error")
    inside = (F.col("below") - slack <= F.col("rank")) & (F.col("up_to") + slack >= F.col("rank"))
    return counted.select("column", "rank", F.col("nb_values").cast("bigint"), inside.alias("in_bound"))


@check(
    "sketched_distinct_zones",
    f"WITH {SILVER} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(DISTINCT {c}) AS nb_distinct, 0.0::DOUBLE AS relative_error FROM silver"
        for c in sketches.ZONES
    ),
)
def sketched_distinct_zones(spark, sf_dir):
    """There are fewer zones than a sketch holds, so the counts are exact."""
    return sketches.sketched_distinct(_stored_sketches(spark, sf_dir)[0])


@check(
    "sketched_zone_changes",
    f"""WITH {SILVER}, zones AS (
      SELECT DISTINCT 'PULocationID' AS name, year * 12 + month AS at, PULocationID AS zone FROM silver
      WHERE PULocationID IS NOT NULL
      UNION SELECT DISTINCT 'DOLocationID', year * 12 + month, DOLocationID FROM silver WHERE DOLocationID IS NOT NULL),
    months AS (SELECT DISTINCT name, year, month, year * 12 + month AS at
      FROM silver, (SELECT unnest(['PULocationID', 'DOLocationID']) AS name)),
    pairs AS (SELECT m.name, m.year, m.month, m.at FROM months m JOIN months p ON p.name = m.name AND p.at = m.at - 1),
    sides AS (
      SELECT p.name, p.year, p.month, z.zone, bool_or(z.at = p.at) AS now, bool_or(z.at = p.at - 1) AS before
      FROM pairs p JOIN zones z ON z.name = p.name AND z.at BETWEEN p.at - 1 AND p.at GROUP BY ALL)
    SELECT name AS "column", year, month, count(*) FILTER (now AND before) AS nb_both,
      count(*) FILTER (before AND NOT now) AS nb_before_only, count(*) FILTER (now AND NOT before) AS nb_now_only
    FROM sides GROUP BY ALL""",
)
def sketched_zone_changes(spark, sf_dir):
    return sketches.distinct_changes(_stored_sketches(spark, sf_dir)[0])


@check(
    "sketched_top_zones",
    f"""WITH {SILVER} SELECT CAST(PULocationID AS BIGINT) AS value, count(*) AS nb_trips, 0.0::DOUBLE AS most_off
    FROM silver WHERE PULocationID IS NOT NULL GROUP BY 1 ORDER BY nb_trips DESC, value LIMIT 15""",
)
def sketched_top_zones(spark, sf_dir):
    return sketches.sketched_top(_stored_sketches(spark, sf_dir)[0], "PULocationID")


# rejects


def _text_passengers(spark, sf_dir):
    """Trips whose passengers are text, some of it no number."""
    text = F.when((F.col("payment_type") == 3) & (F.col("DOLocationID") % 3 == 0), "n/a").otherwise(
        F.col("passenger_count").cast("string")
    )
    return inputs.bronze_trips(spark, sf_dir).withColumn("passenger_count", text)


_TEXT = f"""{BRONZE},
texts AS (SELECT * REPLACE (CASE WHEN payment_type = 3 AND DOLocationID % 3 = 0 THEN 'n/a'
    ELSE CAST(passenger_count AS VARCHAR) END AS passenger_count) FROM bronze),
judged AS (
  SELECT *, CASE WHEN NOT ({COMPLETE}) THEN 'missing_value'
      WHEN passenger_count = 'n/a' THEN 'unreadable_passenger_count'
      ELSE {REASON.replace('passenger_count', 'TRY_CAST(passenger_count AS INTEGER)')} END AS rule
  FROM (SELECT *, count(*) AS nb_copies FROM texts GROUP BY ALL)
)"""


@check("trips_rejected", f"WITH {_TEXT} SELECT * FROM judged WHERE rule <> 'rows_out'")
def trips_rejected(spark, sf_dir):
    return rejects.rejected_trips(_text_passengers(spark, sf_dir))


@check(
    "trips_unreadable_values",
    f"WITH {_TEXT} SELECT 'passenger_count' AS column, passenger_count AS value, count(*) AS nb_rows "
    "FROM texts WHERE passenger_count = 'n/a' GROUP BY 2",
)
def trips_unreadable_values(spark, sf_dir):
    return rejects.unreadable_values(_text_passengers(spark, sf_dir))


@check(
    "trips_tried_again",
    f"""WITH {SILVER.replace('fare_amount BETWEEN 0 AND 500', 'fare_amount BETWEEN 500 AND 600 AND fare_amount > 500')}
    SELECT * FROM silver""",
)
def trips_tried_again(spark, sf_dir):
    """Rejected rows that pass when higher fares are allowed."""
    rejected = rejects.rejected_trips(inputs.bronze_trips(spark, sf_dir))
    return rejects.tried_again(rejected, CleaningRules(max_fare=600.0))
