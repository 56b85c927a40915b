"""Declared schemas of the layers and raw sources."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: official names of the trip files -> names used everywhere else
TRIP_RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}

# columns that must hold a value for a trip to be usable
REQUIRED = (
    "pickup_datetime",
    "dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "passenger_count",
)

TRIP_TYPES = {
    "pickup_datetime": T.TimestampType(),
    "dropoff_datetime": T.TimestampType(),
    "trip_distance": T.DoubleType(),
    "fare_amount": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "tip_amount": T.DoubleType(),
    "tolls_amount": T.DoubleType(),
    "passenger_count": T.IntegerType(),
}

# codes that are passed on as they are
CODE_TYPES = {
    "payment_type": T.LongType(),
    "PULocationID": T.LongType(),
    "DOLocationID": T.LongType(),
}

DERIVED_TYPES = {
    "pickup_hour": T.IntegerType(),
    "pickup_dayofweek": T.IntegerType(),
    "is_weekend": T.BooleanType(),
    "trip_duration_minutes": T.DoubleType(),
    "price_per_mile": T.DoubleType(),
}

SILVER_PARTITIONS = ("year", "month")


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


BRONZE = _struct(TRIP_TYPES | CODE_TYPES)
SILVER = _struct(
    TRIP_TYPES
    | CODE_TYPES
    | DERIVED_TYPES
    | {name: T.IntegerType() for name in SILVER_PARTITIONS}
)

# fixed values: the hourly weather variables
WEATHER_VARIABLES = (
    "temperature_2m",
    "precipitation",
    "relative_humidity_2m",
    "wind_speed_10m",
)

WEATHER = _struct(
    {
        "timezone": T.StringType(),
        "hourly": _struct(
            {"time": T.ArrayType(T.StringType())}
            | {name: T.ArrayType(T.DoubleType()) for name in WEATHER_VARIABLES}
        ),
    }
)

NEWS_ITEM = _struct(
    {
        "title": T.StringType(),
        "link": T.StringType(),
        "pubDate": T.StringType(),
        "source": _struct({"_VALUE": T.StringType(), "_url": T.StringType()}),
    }
)

METRIC_SAMPLES = _struct(
    {
        "ts": T.TimestampType(),
        "metric": T.StringType(),
        "labels": T.MapType(T.StringType(), T.StringType()),
        "value": T.DoubleType(),
    }
)
