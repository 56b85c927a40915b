"""Raw trips to clean trips.

The order of the steps is part of the contract: copies are removed from the rows as they were
read, missing values are judged before types are cast, and bounds after. Catalyst moves the
filters below the deduplication by itself, so the declared order costs nothing.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import CleaningRules, use_utc
from tripmart.functions.numeric import positive_ratio
from tripmart.functions.temporal import is_weekend_day, minutes_between
from tripmart.schema import CODE_TYPES, REQUIRED, TRIP_RENAMES, TRIP_TYPES


def rename_present(df: DataFrame, names: dict[str, str] = TRIP_RENAMES) -> DataFrame:
    """Rename the columns that exist; other names in the map are ignored."""
    return df.withColumnsRenamed(names)


def without_copies(df: DataFrame) -> DataFrame:
    """One row of each group of fully equal rows.

    Copies collapse in the map-side half of the aggregate, so even a row that makes up a third
    of the table reaches the shuffle once per input task.
    """
    return df.distinct()


def in_time_ranges(df: DataFrame) -> DataFrame:
    """Rows dealt by ranges of pickup time and, within one moment, of the other columns.

    Equal rows meet, so their removal needs no shuffle of its own, and a task holds neighbouring
    months. Fractions are no keys, since grouping takes some that differ in bits as equal.
    """
    fractions = (T.FloatType, T.DoubleType)
    keys = [f.name for f in df.schema if not isinstance(f.dataType, fractions)]
    return df.repartitionByRange("pickup_datetime", *[f"`{k}`" for k in keys if k != "pickup_datetime"])


def _lacks_value(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def lacks_required(df: DataFrame, required: tuple[str, ...]) -> Column:
    """Whether a required column that the input has is null or NaN."""
    tests = [_lacks_value(df, name) for name in required if name in df.columns]
    return reduce(or_, tests, F.lit(False))


def with_required(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows without a null or NaN in the required columns that the input has."""
    return df.dropna(subset=[name for name in required if name in df.columns])


def with_types(df: DataFrame, types: dict[str, T.DataType] = TRIP_TYPES) -> DataFrame:
    """Cast to the declared types; a value that cannot be cast becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def with_wide_codes(df: DataFrame) -> DataFrame:
    """Codes stored as smaller integers become bigints, so that all files of a table agree."""
    narrow = (T.ByteType, T.ShortType, T.IntegerType)
    codes = [n for n in CODE_TYPES if n in df.columns and isinstance(df.schema[n].dataType, narrow)]
    return df.withColumns({name: F.col(name).cast(CODE_TYPES[name]) for name in codes})


def in_time_order(df: DataFrame) -> DataFrame:
    return df.where(F.col("dropoff_datetime") > F.col("pickup_datetime"))


def with_trip_measures(df: DataFrame) -> DataFrame:
    """Hour, weekday, weekend flag, duration in minutes and price per mile."""
    pickup, day = F.col("pickup_datetime"), F.dayofweek("pickup_datetime")
    return df.withColumns(
        {
            "pickup_hour": F.hour(pickup),
            "pickup_dayofweek": day,
            "is_weekend": is_weekend_day(day),
            "trip_duration_minutes": minutes_between(pickup, F.col("dropoff_datetime")),
            "price_per_mile": positive_ratio(F.col("total_amount"), F.col("trip_distance")),
        }
    )


def within_bounds(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return df.where(reduce(and_, rules.checks().values()))


def with_month(df: DataFrame) -> DataFrame:
    """The two columns the clean table is partitioned by."""
    pickup = F.col("pickup_datetime")
    return df.withColumns({"year": F.year(pickup), "month": F.month(pickup)})


def pickup_month(df: DataFrame) -> Column:
    """First day of the month of a raw trip; null where the time is missing or no time."""
    pickup = F.col("pickup_datetime")
    if isinstance(df.schema["pickup_datetime"].dataType, T.StringType):
        pickup = pickup.try_cast("timestamp")
    return F.trunc(pickup.cast("date"), "month")


def picked_up_between(df: DataFrame, start: date, end: date) -> DataFrame:
    """Raw trips of a range of days, ``end`` excluded.

    Equal rows have equal pickup times, so a range can be cleaned on its own with the same
    result. The bounds have the type of the column, hence row groups of other days are skipped.
    """
    raw = rename_present(df)
    pickup, kind = F.col("pickup_datetime"), raw.schema["pickup_datetime"].dataType
    if isinstance(kind, T.StringType):
        pickup, kind = pickup.try_cast("timestamp"), T.TimestampType()
    first, last = (F.lit(day.isoformat()).cast(kind) for day in (start, end))
    return raw.where((pickup >= first) & (pickup < last))


def clean(df: DataFrame, rules: CleaningRules = CleaningRules(), by_time: bool = False) -> DataFrame:
    """The whole cleaning pipeline; ``by_time`` leaves the trips in ranges of pickup time."""
    use_utc(df.sparkSession)
    raw = rename_present(df)
    return (
        (in_time_ranges(raw) if by_time else raw)
        .transform(without_copies)
        .transform(with_required)
        .transform(with_types)
        .transform(with_wide_codes)
        .transform(in_time_order)
        .transform(with_trip_measures)
        .transform(within_bounds, rules)
        .transform(with_month)
    )


def row_accounting(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Rows read, removed by each rule, and kept, as ``(step, nb_rows)`` in one pass.

    A row that breaks several rules counts for the first one. This is an aggregate and not an
    accumulator, so a task that is run again never counts twice.
    """
    use_utc(df.sparkSession)
    raw = rename_present(df)
    copies, lacking, reason = "_copies", "_lacking", "_reason"
    checked = (
        raw.groupBy(*raw.columns)
        .agg(F.count("*").alias(copies))
        .withColumn(lacking, lacks_required(raw, REQUIRED))
        .transform(with_types)
        .transform(with_trip_measures)
    )
    ordered = F.col("dropoff_datetime") > F.col("pickup_datetime")
    rejects = {"missing_value": ~F.col(lacking), "not_in_time_order": ordered} | rules.checks()
    first_broken = F.coalesce(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rejects.items()]
    )
    steps = {
        "rows_in": F.sum(copies),
        "duplicate": F.sum(copies) - F.count("*"),
        **{name: F.count_if(F.col(reason) == name) for name in rejects},
        "rows_out": F.count_if(F.col(reason).isNull()),
    }
    totals = checked.select(copies, first_broken.alias(reason)).agg(
        *[F.coalesce(count, F.lit(0)).alias(step) for step, count in steps.items()]
    )
    return totals.unpivot([], list(steps), "step", "nb_rows")
