from __future__ import annotations

import math
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plans import plan_of
from tripmart.config import CleaningRules, KpiSink, scratch_path, session_settings
from tripmart.operators.cleaning import clean, picked_up_between
from tripmart.operators.kpis import CATALOGUE, kpi_table
from tripmart.plans.gold import run_gold, write_gold
from tripmart.plans.runs import measured, record
from tripmart.plans.silver import (
    BYTES_PER_TASK,
    run_silver,
    run_silver_by_month,
    shuffle_partitions_for,
)
from tripmart.sinks.tables import read_kpi, write_kpi, write_silver
from tripmart.sources.trips import read_bronze, read_silver

APRIL = {"pickup_datetime": "2024-04-02 10:00:00", "dropoff_datetime": "2024-04-02 10:30:00"}


def same_rows(a, b) -> bool:
    return sorted(a.collect(), key=str) == sorted(b.select(*a.columns).collect(), key=str)


def test_silver_round_trip(spark, trips, tmp_path):
    silver = clean(trips({}, {"tip_amount": None}, APRIL))
    written = write_silver(silver, str(tmp_path / "s"))
    assert (written.rows, written.months) == (3, ((2024, 3), (2024, 4)))
    stored = read_silver(spark, str(tmp_path / "s"))
    assert same_rows(silver, stored)
    assert stored.schema["year"].dataType.simpleString() == "int"
    assert "note" in stored.columns
    assert len(list((tmp_path / "s").glob("year=*/month=*/*.parquet"))) == 2


@pytest.mark.parametrize(("stored", "expected"), [("int", "bigint"), ("double", "double")])
def test_codes_are_widened_but_not_changed(spark, trips, tmp_path, stored, expected):
    raw = trips({"PULocationID": None}, {}).withColumn(
        "PULocationID", F.col("PULocationID").cast(stored)
    )
    write_silver(clean(raw), str(tmp_path / "s"))
    rows = read_silver(spark, str(tmp_path / "s"))
    assert dict(rows.dtypes)["PULocationID"] == expected
    assert {r["PULocationID"] for r in rows.collect()} == {None, 10}


def test_month_filter_prunes_partitions(spark, trips, tmp_path):
    write_silver(clean(trips({}, APRIL)), str(tmp_path / "s"))
    march = read_silver(spark, str(tmp_path / "s"), months=[(2024, 3)])
    assert march.count() == 1
    assert "(month#" in plan_of(march).split("PartitionFilters", 1)[1].split("\n")[0]
    assert read_silver(spark, str(tmp_path / "s"), months=[]).count() == 0


@pytest.mark.parametrize(("replace_all", "left"), [(True, 1), (False, 2)])
def test_static_and_dynamic_overwrite(spark, trips, tmp_path, replace_all, left):
    write_silver(clean(trips({}, APRIL)), str(tmp_path / "s"))
    again = clean(trips({"fare_amount": 50.0}))
    assert write_silver(again, str(tmp_path / "s"), replace_all).rows == 1
    stored = read_silver(spark, str(tmp_path / "s"))
    assert stored.count() == left
    assert stored.where("month = 3").first()["fare_amount"] == 50.0


def test_trips_cleaned_in_time_ranges_are_shuffled_once(spark, trips, tmp_path):
    copy = {"fare_amount": 0.0, "PULocationID": None, "note": None}
    raw = trips({}, {}, copy, copy | {"fare_amount": -0.0}, APRIL, APRIL | {"fare_amount": None}).repartition(3)
    cleaned = clean(raw, by_time=True)
    plan = plan_of(cleaned, "simple")
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan
    assert cleaned.schema == clean(raw).schema
    written = write_silver(cleaned, str(tmp_path / "s"), gathered=True)
    assert (written.rows, written.months) == (3, ((2024, 3), (2024, 4)))
    stored = read_silver(spark, str(tmp_path / "s"))
    assert same_rows(clean(raw), stored)
    assert len(list((tmp_path / "s").glob("year=*/month=*/*.parquet"))) <= 3


def test_more_months_than_are_written_side_by_side(spark, trips, tmp_path):
    days = [f"20{20 + i // 12}-{1 + i % 12:02}-02" for i in range(40)]
    raw = trips(*[{"pickup_datetime": f"{d} 10:00:00", "dropoff_datetime": f"{d} 10:30:00"} for d in days])
    written = write_silver(clean(raw, by_time=True), str(tmp_path / "s"), gathered=True)
    assert written.rows == len(written.months) == 40
    assert same_rows(clean(raw), read_silver(spark, str(tmp_path / "s")))


def test_write_is_split_by_adaptive_execution(spark, trips):
    plan = plan_of(clean(trips({})).hint("rebalance", "year", "month"), "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_silver_job_counts(spark, trips, tmp_path):
    trips({}, {}, {"fare_amount": -1.0}, APRIL).write.parquet(str(tmp_path / "b"))
    metrics = run_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), CleaningRules())
    assert (metrics.rows_in, metrics.rows_out, metrics.rows_rejected) == (4, 2, 2)
    assert metrics.seconds > 0 and metrics.rows_per_second > 0
    record(spark, metrics, str(tmp_path / "runs"))
    record(spark, measured("other", 3, lambda: 1), str(tmp_path / "runs"))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert {(r["job"], r["rows_rejected"]) for r in runs.collect()} == {("silver", 2), ("other", 2)}


def test_months_on_their_own_give_the_same_table(spark, trips, tmp_path):
    december = {"pickup_datetime": "2023-12-31 23:50:00", "dropoff_datetime": "2024-01-01 00:10:00"}
    new_year = {"pickup_datetime": "2024-01-01 00:00:00", "dropoff_datetime": "2024-01-01 00:10:00"}
    raw = trips({}, {}, APRIL, december, december, new_year, {"pickup_datetime": None})
    raw.write.parquet(str(tmp_path / "b"))
    run_silver(spark, str(tmp_path / "b"), str(tmp_path / "whole"))
    for most in (1, 2_500):
        run_silver(spark, str(tmp_path / "b"), str(tmp_path / "batches"), batch_bytes=most)
        both = [read_silver(spark, str(tmp_path / name)) for name in ("whole", "batches")]
        assert same_rows(*both)
    months = [(2023, 12), (2024, 1), (2024, 3), (2024, 4)]
    done = run_silver_by_month(spark, str(tmp_path / "b"), str(tmp_path / "parts"), months)
    assert {m: (r.rows_in, r.rows_out) for m, r in done.items()} == {
        (2023, 12): (2, 1), (2024, 1): (1, 1), (2024, 3): (2, 1), (2024, 4): (1, 1)
    }
    whole = read_silver(spark, str(tmp_path / "whole"))
    assert same_rows(whole, read_silver(spark, str(tmp_path / "parts")))
    # text times are understood as well, and a stray text is no trip of any month
    text = raw.withColumn("pickup_datetime", F.col("pickup_datetime").cast("string"))
    assert picked_up_between(text, date(2023, 12, 1), date(2024, 1, 1)).count() == 2


def test_range_of_days_reaches_the_scan(spark, trips, tmp_path):
    trips({}).write.parquet(str(tmp_path / "b"))
    days = picked_up_between(
        read_bronze(spark, str(tmp_path / "b")), date(2024, 3, 1), date(2024, 4, 1)
    )
    assert "GreaterThanOrEqual(pickup_datetime,2024-03-01T00:00" in plan_of(days)


def test_empty_tables_can_be_written(spark, trips, tmp_path):
    nothing = clean(trips({"fare_amount": -1.0}))
    assert write_silver(nothing, str(tmp_path / "s")).rows == 0
    sink = KpiSink(path=str(tmp_path / "g"))
    counts = write_gold(nothing, sink)
    assert counts.pop("kpi_global_summary") == 1 and set(counts.values()) == {0}


def test_settings_last_for_the_block_only(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with session_settings(spark, spark__sql__shuffle__partitions=77):
        assert spark.conf.get(name) == "77"
    assert spark.conf.get(name) == before
    assert shuffle_partitions_for(spark, 0) == int(before)
    assert shuffle_partitions_for(spark, 10**12) == math.ceil(10**12 / BYTES_PER_TASK)


def test_declared_schema_saves_the_look_at_footers(spark, trips, tmp_path):
    trips({}).write.parquet(str(tmp_path / "b"))
    declared = trips({}).schema
    assert read_bronze(spark, str(tmp_path / "b"), schema=declared).count() == 1


def test_drifting_files_are_conformed(spark, trips, tmp_path):
    folder = str(tmp_path / "b")
    trips({}).drop("note").write.parquet(folder)
    older = trips({"fare_amount": 21.0}).withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("bigint"),
            "PULocationID": F.col("PULocationID").cast("int"),
            "note": F.lit(5),
        }
    )
    older.withColumnsRenamed({"pickup_datetime": "tpep_pickup_datetime"}).write.mode(
        "append"
    ).parquet(folder)
    trips({"fare_amount": 22.0, "note": "n"}).write.mode("append").parquet(folder)
    rows = read_bronze(spark, folder).orderBy("fare_amount").collect()
    assert [(r["passenger_count"], r["PULocationID"], r["note"]) for r in rows] == [
        (1, 10, None),
        (1, 10, "5"),
        (1, 10, "n"),
    ]
    assert clean(read_bronze(spark, folder)).count() == 3


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_bronze(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("kind", ["parquet", "json", "table"])
def test_all_kpis_round_trip(spark, trips, tmp_path, kind):
    silver = clean(trips({}, {"PULocationID": None}, APRIL))
    write_silver(silver, str(tmp_path / "s"))
    if kind == "table":
        spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
        sink = KpiSink(kind="table", database="gold_test")
    else:
        sink = KpiSink(kind=kind, path=str(tmp_path / "g"))
    counts = run_gold(spark, str(tmp_path / "s"), sink)
    assert list(counts) == list(CATALOGUE)
    for name, kpi in CATALOGUE.items():
        stored = read_kpi(spark, kpi, sink)
        assert stored.count() == counts[name]
        assert same_rows(kpi_table(silver, kpi), stored)
    # writing once more replaces
    assert write_gold(silver.where("month = 4"), sink)["kpi_daily_revenue"] == 1
    assert read_kpi(spark, CATALOGUE["kpi_daily_revenue"], sink).count() == 1


def test_sinks_need_their_settings(trips):
    table = kpi_table(clean(trips({})), "kpi_global_summary")
    with pytest.raises(ValueError, match="path"):
        write_kpi(table, "kpi_global_summary", KpiSink())
    with pytest.raises(ValueError, match="MONGO_USER"):
        KpiSink.mongodb_from_env({})
    sink = KpiSink.mongodb_from_env({"MONGO_USER": "u", "MONGO_PASSWORD": "p", "MONGO_HOST": "h"})
    assert sink.options["connection.uri"] == "mongodb://u:p@h/taxi_gold?authSource=admin"


def session_on(settings: dict):
    """Stands for a session with just these settings."""
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)))


def test_scratch_without_a_setting_is_below_the_warehouse():
    first, second = (scratch_path(session_on({"spark.sql.warehouse.dir": "file:/w"}), "x") for _ in range(2))
    assert first != second and first.startswith("file:/w/")


def test_scratch_follows_the_session(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
