"""Profiling tables over the stored clean trips."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from checks import inputs
from checks.registry import check
from checks.sql import SILVER
from tripmart.operators import profiling
from tripmart.schema import SILVER as SILVER_SCHEMA

DIGITS = 6  # quotients, deviations and exponentials differ in the last digits between engines


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _describe_sql(column: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont(CAST({column} AS DOUBLE), {p}), {DIGITS}) AS {name}"
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""SELECT '{column}' AS column, count({column}) AS count,
      round(avg({column}), {DIGITS}) AS mean, round(stddev_samp({column}), {DIGITS}) AS std,
      round(CAST(min({column}) AS DOUBLE), {DIGITS}) AS min, {quartiles},
      round(CAST(max({column}) AS DOUBLE), {DIGITS}) AS max FROM silver"""


@check(
    "profile_describe",
    f"WITH {SILVER} " + " UNION ALL ".join(map(_describe_sql, profiling.NUMERIC_COLUMNS)),
)
def profile_describe(spark, sf_dir):
    summary = profiling.describe(inputs.stored_silver(spark, sf_dir))
    return _rounded(summary, "mean", "std", "min", "p25", "p50", "p75", "max")


_DTYPES = {f.name: f.dataType.simpleString() for f in SILVER_SCHEMA}


@check(
    "profile_column_info",
    f"WITH {SILVER} "
    + " UNION ALL ".join(
        f"SELECT count(*) AS nb_rows, '{name}' AS column, '{dtype}' AS dtype, "
        f"count({name}) AS non_null FROM silver"
        for name, dtype in _DTYPES.items()
    ),
)
def profile_column_info(spark, sf_dir):
    return profiling.column_info(inputs.stored_silver(spark, sf_dir)).drop("position")


@check(
    "profile_missing_values",
    f"WITH {SILVER} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column, count(*) - count({name}) AS nb_missing FROM silver"
        for name in _DTYPES
    )
    + ") WHERE nb_missing > 0",
)
def profile_missing_values(spark, sf_dir):
    return profiling.missing_values(inputs.stored_silver(spark, sf_dir))


def _histogram_sql(column: str) -> str:
    return f"""WITH {SILVER},
    edges AS (SELECT min({column}) AS lo, (max({column}) - min({column})) / 60 AS w FROM silver),
    counted AS (
      SELECT least(CAST(floor(({column} - lo) / w) AS BIGINT), 59) AS bin, count(*) AS n
      FROM silver, edges WHERE {column} IS NOT NULL GROUP BY 1)
    SELECT b.bin, lo + b.bin * w AS bin_start, lo + b.bin * w + w AS bin_end,
      coalesce(n, 0) AS nb_trips
    FROM (SELECT unnest(range(60)) AS bin) b CROSS JOIN edges LEFT JOIN counted USING (bin)"""


def _density_sql(column: str, far: str = "") -> str:
    """The kernel summed over all values, without bins."""
    return f"""WITH {SILVER},
    vals AS (SELECT {column} AS v FROM silver WHERE {column} IS NOT NULL {far}),
    edges AS (
      SELECT min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(v), -0.2e0) AS h FROM vals),
    sizes AS (SELECT v, count(*) AS size FROM vals GROUP BY v),
    grid AS (SELECT unnest(range(200)) AS point)
    SELECT point, round(lo + point * ((hi - lo) / 199), {DIGITS}) AS x,
      round(sum(size * exp(-0.5e0 * pow((lo + point * ((hi - lo) / 199) - v) / h, 2)))
        * ((hi - lo) / 60) / (h * sqrt(2 * pi())), 3) AS density, true AS is_close
    FROM grid, sizes, edges GROUP BY point, lo, hi, h"""


def _density(trips, column):
    """The kernel summed over all values, and whether the binned curve is within 0.1 % of its peak."""
    exact = profiling.exact_density(trips, column)
    binned = profiling.density(trips, column).select("point", F.col("density").alias("binned"))
    peak = F.broadcast(exact.agg(F.max("density").alias("peak")))  # one row
    return exact.join(binned, "point").crossJoin(peak).select(
        "point",
        F.round("x", DIGITS).alias("x"),
        F.round("density", 3).alias("density"),
        (F.abs(F.col("density") - F.col("binned")) <= F.col("peak") / 1000).alias("is_close"),
    )


_FAR = "UNION ALL SELECT 400000.0e0 FROM silver WHERE total_amount > 250"


@check("profile_density_far_values", _density_sql("total_amount", _FAR))
def profile_density_far_values(spark, sf_dir):
    """Values far from all others, which must not coarsen the bins."""
    trips = inputs.stored_silver(spark, sf_dir).select("total_amount")
    far = trips.where("total_amount > 250").select(F.lit(400000.0).alias("total_amount"))
    return _density(trips.union(far), "total_amount")


for _column in ("total_amount", "trip_distance"):

    @check(f"profile_histogram_{_column}", _histogram_sql(_column))
    def profile_histogram(spark, sf_dir, column=_column):
        return profiling.histogram(inputs.stored_silver(spark, sf_dir), column)

    @check(f"profile_density_{_column}", _density_sql(_column))
    def profile_density(spark, sf_dir, column=_column):
        return _density(inputs.stored_silver(spark, sf_dir), column)


def _box_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column, q1, median, q3,
      least(min(CASE WHEN {column} >= q1 - 1.5e0*(q3-q1) THEN {column} END), min(q1)) AS whisker_low,
      greatest(max(CASE WHEN {column} <= q3 + 1.5e0*(q3-q1) THEN {column} END), max(q3)) AS whisker_high,
      count(CASE WHEN {column} NOT BETWEEN q1 - 1.5e0*(q3-q1) AND q3 + 1.5e0*(q3-q1)
            THEN 1 END) AS nb_outliers
    FROM silver, (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS median,
      quantile_cont({column}, 0.75) AS q3 FROM silver) GROUP BY ALL"""


@check(
    "profile_box_statistics",
    f"WITH {SILVER} {_box_sql('total_amount')} UNION ALL {_box_sql('trip_distance')}",
)
def profile_box_statistics(spark, sf_dir):
    trips = inputs.stored_silver(spark, sf_dir)
    return profiling.box_statistics(trips, ("total_amount", "trip_distance"))


@check(
    "profile_trips_per_hour",
    f"WITH {SILVER} SELECT pickup_hour, count(*) AS nb_trips FROM silver GROUP BY 1",
)
def profile_trips_per_hour(spark, sf_dir):
    return profiling.counts_by(inputs.stored_silver(spark, sf_dir), "pickup_hour")


@check(
    "profile_trips_per_weekday",
    f"""WITH {SILVER}
    SELECT CAST(position - 1 AS INTEGER) AS position,
      ['Lun', 'Mar', 'Mer', 'Jeu', 'Ven', 'Sam', 'Dim'][position] AS day_label,
      count(pickup_dayofweek) AS nb_trips
    FROM (SELECT unnest(range(1, 8)) AS position)
    LEFT JOIN silver ON pickup_dayofweek = position % 7 + 1 GROUP BY position""",
)
def profile_trips_per_weekday(spark, sf_dir):
    return profiling.counts_by_weekday(inputs.stored_silver(spark, sf_dir))


@check(
    "profile_mean_price_per_hour",
    f"WITH {SILVER} SELECT pickup_hour, avg(total_amount) AS total_amount FROM silver GROUP BY 1",
)
def profile_mean_price_per_hour(spark, sf_dir):
    trips = inputs.stored_silver(spark, sf_dir)
    return profiling.mean_by(trips, "pickup_hour", "total_amount")


@check(
    "profile_top_pickup_zones",
    f"""WITH {SILVER}
    SELECT PULocationID, count(*) AS count FROM silver WHERE PULocationID IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
)
def profile_top_pickup_zones(spark, sf_dir):
    return profiling.top_values(inputs.stored_silver(spark, sf_dir), "PULocationID")


def _pairs_sql(columns, source="silver") -> str:
    cells = [
        f"SELECT '{x}' AS x, '{y}' AS y, "
        f"round(nullif(corr({x}, {y}), 'nan'::DOUBLE), {DIGITS}) AS r FROM {source}"
        for a, b in combinations(columns, 2)
        for x, y in ((a, b), (b, a))
    ]
    cells += [f"SELECT '{c}', '{c}', 1.0e0" for c in columns]
    return " UNION ALL ".join(cells)


@check(
    "profile_correlations", f"WITH {SILVER} {_pairs_sql(profiling.CORRELATED_COLUMNS)}"
)
def profile_correlations(spark, sf_dir):
    return _rounded(profiling.correlation_matrix(inputs.stored_silver(spark, sf_dir)), "r")
