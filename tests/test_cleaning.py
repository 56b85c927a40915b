from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plans import plan_of
from tripmart.config import CleaningRules
from tripmart.operators import cleaning
from tripmart.schema import DERIVED_TYPES, SILVER_PARTITIONS, TRIP_TYPES

NAN = float("nan")


def kept(df) -> int:
    return cleaning.clean(df).count()


@pytest.mark.parametrize(
    "pair",
    [
        ({}, {}),
        ({"tip_amount": 0.0}, {"tip_amount": -0.0}),
        ({"tip_amount": NAN}, {"tip_amount": NAN}),
        ({"tip_amount": None}, {"tip_amount": None}),
    ],
)
def test_copies_become_one_row(trips, pair):
    assert kept(trips(*pair)) == 1


def test_rows_that_differ_anywhere_are_no_copies(trips):
    assert kept(trips({}, {"note": "b"})) == 2


@pytest.mark.parametrize(
    "name",
    ["trip_distance", "fare_amount", "total_amount", "passenger_count", "pickup_datetime"],
)
def test_missing_required_value_drops_the_row(trips, name):
    assert kept(trips({name: None})) == 0
    if name != "pickup_datetime":
        assert kept(trips({name: NAN})) == 0


def test_missing_tip_or_toll_is_kept(trips):
    assert kept(trips({"tip_amount": None, "tolls_amount": None})) == 1


def test_columns_absent_from_the_input_are_not_required(trips):
    raw = trips({}).drop("passenger_count")
    assert cleaning.with_required(raw).count() == 1


def test_official_names_give_the_same_rows(trips):
    raw = trips({}, {"fare_amount": 30.0})
    official = raw.withColumnsRenamed(
        {
            "pickup_datetime": "tpep_pickup_datetime",
            "dropoff_datetime": "tpep_dropoff_datetime",
        }
    )
    plain = cleaning.clean(raw)
    assert sorted(cleaning.clean(official).collect()) == sorted(plain.collect())


@pytest.mark.parametrize(
    ("end", "rows"),
    [
        ("2024-03-06 10:00:00", 0),
        ("2024-03-06 09:59:00", 0),
        ("2024-03-06 10:00:00.700", 0),
        ("2024-03-06 10:00:01", 1),
        ("2024-03-06 13:00:00", 1),
        ("2024-03-06 13:00:01", 0),
        ("2024-03-06 13:00:00.900", 1),
    ],
)
def test_durations(trips, end, rows):
    assert kept(trips({"dropoff_datetime": end})) == rows


@pytest.mark.parametrize(
    ("name", "inside", "outside"),
    [
        ("fare_amount", (0.0, 500.0), (-0.01, 500.01)),
        ("trip_distance", (0.1, 100.0), (0.0, 0.09, 100.01, -1.0)),
        ("passenger_count", (1.0, 6.0, 1.9, 6.9), (0.0, 0.5, 7.0)),
    ],
)
def test_bounds(trips, name, inside, outside):
    assert kept(trips(*[{name: v} for v in inside])) == len(inside)
    assert kept(trips(*[{name: v} for v in outside])) == 0


def test_passengers_are_truncated(trips):
    assert cleaning.clean(trips({"passenger_count": 1.9})).first()["passenger_count"] == 1


def test_bad_text_becomes_null_and_does_not_fail(trips):
    raw = trips({}).withColumn("tip_amount", F.lit("x"))
    assert cleaning.clean(raw).first()["tip_amount"] is None


def test_a_total_that_cannot_be_cast_survives_as_null(trips):
    raw = trips({}).withColumn("total_amount", F.lit("x"))
    row = cleaning.clean(raw).first()
    assert row["total_amount"] is None and row["price_per_mile"] is None


def test_strict_rules_are_off_by_default(trips):
    odd = trips(
        {"total_amount": -5.0},
        {"pickup_datetime": "1970-01-01 10:00:00", "dropoff_datetime": "1970-01-01 10:05:00"},
    )
    assert kept(odd) == 2
    strict = CleaningRules(min_total=0.0, first_date="2009-01-01", last_date="2030-12-31")
    assert cleaning.clean(odd, strict).count() == 0


@pytest.mark.parametrize(
    ("day", "number", "weekend"),
    [("08", 6, False), ("09", 7, True), ("10", 1, True), ("11", 2, False)],
)
def test_weekdays(trips, day, number, weekend):
    change = {
        "pickup_datetime": f"2024-03-{day} 23:10:00",
        "dropoff_datetime": f"2024-03-{day} 23:20:30",
    }
    row = cleaning.clean(trips(change)).first()
    assert (row["pickup_dayofweek"], row["is_weekend"]) == (number, weekend)
    assert (row["pickup_hour"], row["year"], row["month"]) == (23, 2024, 3)
    assert row["trip_duration_minutes"] == 10.5
    assert row["price_per_mile"] == 5.0


def test_session_zone_does_not_matter(spark, trips):
    raw = trips({"pickup_datetime": "2024-03-10 02:30:00", "dropoff_datetime": "2024-03-10 03:10:00"})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    row = cleaning.clean(raw).first()
    assert (row["pickup_hour"], row["trip_duration_minutes"]) == (2, 40.0)


def test_declared_types_and_other_columns(trips):
    schema = cleaning.clean(trips({})).schema
    for name, kind in (TRIP_TYPES | DERIVED_TYPES).items():
        assert schema[name].dataType == kind
    for name in SILVER_PARTITIONS:
        assert schema[name].dataType == T.IntegerType()
    assert "note" in schema.names


def test_cleaning_clean_rows_changes_nothing(trips):
    raw = trips({}, {"fare_amount": 1.0}, {"fare_amount": 900.0}, {})
    once = cleaning.clean(raw)
    again = cleaning.clean(once.select(*raw.columns))
    assert sorted(again.collect()) == sorted(once.collect())


def test_cleaning_ignores_a_second_copy_of_the_table(trips):
    raw = trips({}, {"fare_amount": 1.0}, {"fare_amount": None})
    assert kept(raw.unionAll(raw)) == kept(raw) == 2


def test_row_accounting_adds_up(trips):
    raw = trips(
        {},
        {},
        {"fare_amount": None},
        {"total_amount": NAN},
        {"dropoff_datetime": "2024-03-06 09:00:00"},
        {"fare_amount": -1.0},
        {"trip_distance": 0.0},
        {"passenger_count": 9.0},
        {"dropoff_datetime": "2024-03-06 20:00:00"},
    )
    steps = {row["step"]: row["nb_rows"] for row in cleaning.row_accounting(raw).collect()}
    assert steps == {
        "rows_in": 9,
        "duplicate": 1,
        "missing_value": 2,
        "not_in_time_order": 1,
        "fare_out_of_range": 1,
        "distance_out_of_range": 1,
        "passengers_out_of_range": 1,
        "duration_out_of_range": 1,
        "rows_out": 1,
    }
    assert steps["rows_out"] == kept(raw)


def test_row_accounting_of_nothing(trips):
    steps = cleaning.row_accounting(trips({}).limit(0)).collect()
    assert {row["nb_rows"] for row in steps} == {0}


def test_plan_pushes_filters_below_the_deduplication(spark, trips, tmp_path):
    trips({}).write.parquet(str(tmp_path / "t"))
    plan = plan_of(cleaning.clean(spark.read.parquet(str(tmp_path / "t"))))
    assert "GreaterThanOrEqual(fare_amount,0.0)" in plan
    assert plan.count("hashpartitioning(") == 1
    assert "Python" not in plan
