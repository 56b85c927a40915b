"""The tables behind an exploratory study: statistics, distributions, counts, correlations.

Nulls and NaN are left out, as data-frame libraries do; every table is a Spark aggregate whose
size does not depend on the number of trips. Operators that scan more than once say so: pass
them a stored table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.labels import WEEKDAY_LABELS, weekday_label, weekday_position
from tripmart.functions.numeric import present
from tripmart.operators.kpis import top_by_count
from tripmart.operators.quantiles import (
    ColumnRange,
    column_ranges,
    column_statistics,
    exact_quantiles,
)

# fixed values: columns that are described and correlated
NUMERIC_COLUMNS = (
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "passenger_count",
    "trip_duration_minutes",
    "price_per_mile",
)
CORRELATED_COLUMNS = (
    "trip_distance",
    "trip_duration_minutes",
    "passenger_count",
    "tip_amount",
    "total_amount",
)
HISTOGRAM_BINS = 60
DENSITY_POINTS = 200
# bins per bandwidth of the kernel, and how many bandwidths it reaches: exp(-9**2 / 2) < 3e-18
DENSITY_BINS, DENSITY_REACH = 16, 9
QUARTILES = (0.25, 0.5, 0.75)

_SUMMARY = T.StructType(
    [T.StructField("column", T.StringType()), T.StructField("count", T.LongType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in ("mean", "std", "min", "p25", "p50", "p75", "max")
    ]
)


def describe(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each column.

    One scan for the moments and a few more for the quartiles (see ``quantiles``).
    """
    value = F.col("value")
    ranges, rows = column_statistics(
        df,
        columns,
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(df, columns, QUARTILES, ranges)

    def statistic(name: str, which: str) -> float | None:
        return rows[name][which] if name in rows else None

    summary = [
        (
            name,
            ranges[name].count,
            *[statistic(name, which) for which in ("mean", "std", "min")],
            *quartiles[name],
            statistic(name, "max"),
        )
        for name in columns
    ]
    return df.sparkSession.createDataFrame(summary, _SUMMARY)


def approximate_describe(
    df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, accuracy: int = 10_000
) -> DataFrame:
    """``describe`` in a single scan, with quartiles off by at most ``1 / accuracy`` in rank."""
    per_column = []
    for name in columns:
        value = present(F.col(name))
        quartile = F.percentile_approx(value, list(QUARTILES), accuracy)
        per_column.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(value).alias("count"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                quartile[0].alias("p25"),
                quartile[1].alias("p50"),
                quartile[2].alias("p75"),
                F.max(value).alias("max"),
            )
        )
    return df.agg(F.array(*per_column).alias("summaries")).select(F.inline("summaries"))


def column_info(df: DataFrame) -> DataFrame:
    """Type and number of non-null values of each column, with the row count, in one scan."""
    per_column = F.array(
        *[
            F.struct(
                F.lit(place).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("dtype"),
                F.count(F.col(f"`{field.name}`")).alias("non_null"),
            )
            for place, field in enumerate(df.schema)
        ]
    )
    counted = df.agg(F.count("*").alias("nb_rows"), per_column.alias("columns"))
    return counted.select("nb_rows", F.inline("columns"))


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with null or NaN values and how many, most first, in one scan."""

    def missing(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return F.count_if(value.isNull() | F.isnan(value))
        return F.count_if(value.isNull())

    counted = df.agg(*[missing(field).alias(field.name) for field in df.schema])
    listed = counted.unpivot([], df.columns, "column", "nb_missing")
    return listed.where(F.col("nb_missing") > 0).orderBy(F.desc("nb_missing"), "column")


def _place(value: Column, low: float, width: float, bins: int) -> Column:
    """Bin of a value; bins are closed on the left, the last one on both sides."""
    return F.least(F.floor((value - low) / width), F.lit(bins - 1))


def _bounds(df: DataFrame, column: str) -> ColumnRange | None:
    known = column_ranges(df, [column])[column]
    return known if known.finite else None


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal bins between the extremes, empty bins included.

    Two scans: the extremes, then the counts. Infinite values have no bin. Where all values are
    equal, the range is widened by a half on both sides.
    """
    known = _bounds(df, column)
    if known is None:
        return _empty(df, "bin bigint, bin_start double, bin_end double, nb_trips bigint")
    low, high = known.low, known.high
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    value = present(F.col(column))
    counted = (
        df.where(F.abs(value) < math.inf)
        .groupBy(_place(value, low, width, bins).alias("bin"))
        .agg(F.count("*").alias("nb_trips"))
    )
    start = F.lit(low) + F.col("bin") * F.lit(width)
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .select(
            "bin",
            start.alias("bin_start"),
            (start + width).alias("bin_end"),
            F.coalesce("nb_trips", F.lit(0)).alias("nb_trips"),
        )
    )


def density(
    df: DataFrame,
    column: str,
    points: int = DENSITY_POINTS,
    bins_per_bandwidth: int = DENSITY_BINS,
    shown_bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Gaussian kernel density on an even grid between the extremes, in counts per shown bin.

    The bandwidth follows Scott's rule. The kernel is summed over a histogram whose bins are
    a fixed part of the bandwidth, with the mean of the values in each bin for their place, so
    the error is below a thousandth of the peak whatever the range. Only bins that hold values
    exist, and each meets only the grid points in its reach. Two scans; the first one runs when this
    is called and brings one row to the driver. ``exact_density`` does without the bins.
    """
    return _kernel_density(df, column, points, bins_per_bandwidth, shown_bins)


def exact_density(
    df: DataFrame,
    column: str,
    points: int = DENSITY_POINTS,
    shown_bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """``density`` with the kernel summed over all values instead of bins.

    Equal values are combined before their shuffle, and each distinct one meets the grid points in
    its reach, beyond which the kernel is below the precision of a double. Two scans as well.
    """
    return _kernel_density(df, column, points, None, shown_bins)


def _kernel_density(
    df: DataFrame, column: str, points: int, bins_per_bandwidth: int | None, shown_bins: int
) -> DataFrame:
    """The kernel summed over bins of a part of the bandwidth, or over the distinct values."""
    value = F.when(F.abs(present(F.col(column))) < math.inf, F.col(column).cast("double"))
    row = df.agg(
        F.count(value).alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.stddev_samp(value).alias("std"),
    ).first()
    if row["n"] < 2 or not row["std"]:
        return _empty(df, "point bigint, x double, density double")
    n, low, high = row["n"], row["low"], row["high"]
    bandwidth = row["std"] * n ** (-1.0 / 5.0)
    step = (high - low) / (points - 1)
    scale = (high - low) / shown_bins / (bandwidth * math.sqrt(2.0 * math.pi))
    place = value - low
    if bins_per_bandwidth is not None:
        place = F.floor(place / (bandwidth / bins_per_bandwidth))
    binned = (
        df.where(value.isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.count("*").alias("size"), F.avg(value - low).alias("centre"))
    )
    if bins_per_bandwidth is None:
        binned = binned.withColumn("centre", F.col("bin"))
    distance = (F.col("point") * step - F.col("centre")) / bandwidth
    reach = DENSITY_REACH * bandwidth
    first = F.greatest(F.lit(0), F.ceil((F.col("centre") - reach) / step)).cast("bigint")
    last = F.least(F.lit(points - 1), F.floor((F.col("centre") + reach) / step)).cast("bigint")
    near = F.when(first <= last, F.sequence(first, last))
    weights = (
        binned.withColumn("point", F.explode(near))
        .groupBy("point")
        .agg(F.sum(F.col("size") * F.exp(distance * distance * -0.5)).alias("weight"))
    )
    grid = df.sparkSession.range(points).toDF("point")
    x = F.lit(low) + F.col("point") * step
    return grid.join(weights, "point", "left").select(
        "point", x.alias("x"), (F.coalesce("weight", F.lit(0.0)) * scale).alias("density")
    )


def box_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier count of each column."""
    ranges = column_ranges(df, columns)
    quartiles = exact_quantiles(df, columns, QUARTILES, ranges)
    per_column = []
    for name in columns:
        q1, median, q3 = quartiles[name]
        value = present(F.col(name))
        reach = None if q1 is None else 1.5 * (q3 - q1)
        inside = F.lit(False) if q1 is None else value.between(q1 - reach, q3 + reach)
        per_column.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(q1).cast("double").alias("q1"),
                F.lit(median).cast("double").alias("median"),
                F.lit(q3).cast("double").alias("q3"),
                # a whisker never ends inside the box
                F.least(F.min(F.when(inside, value)), F.lit(q1)).alias("whisker_low"),
                F.greatest(F.max(F.when(inside, value)), F.lit(q3)).alias("whisker_high"),
                (F.count(value) - F.count(F.when(inside, value))).alias("nb_outliers"),
            )
        )
    return df.agg(F.array(*per_column).alias("boxes")).select(F.inline("boxes"))


def counts_by(df: DataFrame, key: str) -> DataFrame:
    """Trips per value of a column, nulls left out."""
    known = df.where(F.col(key).isNotNull())
    return known.groupBy(key).agg(F.count("*").alias("nb_trips")).orderBy(key)


def counts_by_weekday(df: DataFrame) -> DataFrame:
    """Trips per weekday label in display order; days without a trip show 0."""
    counted = df.groupBy("pickup_dayofweek").agg(F.count("*").alias("nb_trips"))
    days = df.sparkSession.range(min(WEEKDAY_LABELS), max(WEEKDAY_LABELS) + 1).select(
        F.col("id").cast("int").alias("pickup_dayofweek")
    )
    day = F.col("pickup_dayofweek")
    return (
        days.join(counted, "pickup_dayofweek", "left")
        .select(
            weekday_position(day).alias("position"),
            weekday_label(day).alias("day_label"),
            F.coalesce("nb_trips", F.lit(0)).alias("nb_trips"),
        )
        .orderBy("position")
    )


def mean_by(df: DataFrame, key: str, column: str) -> DataFrame:
    """Mean of a column per value of another one, null keys left out."""
    known = df.where(F.col(key).isNotNull())
    return known.groupBy(key).agg(F.avg(present(F.col(column))).alias(column)).orderBy(key)


def top_values(df: DataFrame, key: str, limit: int = 15) -> DataFrame:
    """The most frequent values of a column, nulls left out; lowest value first among ties."""
    known = df.where(F.col(key).isNotNull())
    return top_by_count(known.groupBy(key).agg(F.count("*").alias("count")), key, limit, "count")


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] = CORRELATED_COLUMNS
) -> DataFrame:
    """Pearson correlation of all pairs in long form ``(x, y, r)``, in one scan.

    A pair uses the rows where both columns have a value. A constant column gives null; the
    built-in ``corr`` would fail on it under ANSI mode.
    """
    n = len(columns)
    cells = []
    for i, j in combinations_with_replacement(range(n), 2):
        x, y = present(F.col(columns[i])), present(F.col(columns[j]))
        cells += [F.lit(i * n + j), F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)]
    nb_pairs = F.lit(n * (n + 1) // 2)
    spread = F.sqrt(F.var_pop("first")) * F.sqrt(F.var_pop("second"))
    moments = (
        df.select(F.stack(nb_pairs, *cells).alias("pair", "first", "second"))
        .groupBy("pair")
        .agg(F.covar_pop("first", "second").alias("shared"), spread.alias("spread"))
    )
    i, j = F.expr(f"id div {n}"), F.expr(f"id % {n}")
    r = F.when(i == j, F.when(F.col("spread") > 0, F.lit(1.0))).otherwise(
        F.try_divide("shared", "spread")
    )

    def name(place: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, columns)), (place + 1).cast("int"))

    return (
        df.sparkSession.range(n * n)
        .withColumn("pair", F.least(i, j) * n + F.greatest(i, j))
        .join(moments, "pair", "left")
        .select(name(i).alias("x"), name(j).alias("y"), r.alias("r"))
    )
