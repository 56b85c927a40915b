"""Jobs that go on from earlier runs."""

from __future__ import annotations

import os
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmart.config import SourceSpec, default_sources
from tripmart.schema import METRIC_SAMPLES
from tripmart.sinks.snapshots import delete_folder
from tripmart.sources.trips import read_bronze
from tripmart.streaming import copies, landing
from tripmart.streaming.copies import read_unique, unique_trips
from tripmart.streaming.landing import land_new, landed_files


def write_file(trips, folder, name):
    """Trips as one file of this name."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}-{name}"
    trips.coalesce(1).write.parquet(part)
    (file,) = [f for f in os.listdir(part) if f.endswith(".parquet")]
    os.replace(f"{part}/{file}", f"{folder}/{name}")


# landing


def test_a_run_lands_only_what_is_new(spark, trips, tmp_path):
    folder, target, log = str(tmp_path / "raw"), str(tmp_path / "landed"), str(tmp_path / "log")
    sources = [SourceSpec("taxi", folder, "*.parquet", layout="rows"), SourceSpec("weather", str(tmp_path / "w"), "*.json")]
    write_file(trips({}, {}), folder, "a.parquet")
    assert land_new(spark, sources, target, log) == {"taxi": 1, "weather": 0}
    first = {f: os.path.getmtime(f"{target}/taxi/landed_file=a.parquet/{f}") for f in os.listdir(f"{target}/taxi/landed_file=a.parquet")}
    older = trips({"fare_amount": 30.0}).withColumn("passenger_count", F.lit(2)).withColumn("extra", F.lit("x"))
    write_file(older, folder, "b c.parquet")
    os.makedirs(tmp_path / "w")
    (tmp_path / "w" / "one.json").write_text("{}")
    assert land_new(spark, sources, target, log) == {"taxi": 1, "weather": 1}
    again = {f: os.path.getmtime(f"{target}/taxi/landed_file=a.parquet/{f}") for f in os.listdir(f"{target}/taxi/landed_file=a.parquet")}
    assert first == again
    assert land_new(spark, sources, target, log) == {"taxi": 0, "weather": 0}
    rows = read_bronze(spark, f"{target}/taxi")
    assert sorted(r["fare_amount"] for r in rows.collect()) == [20.0, 20.0, 30.0]
    listed = landed_files(spark, target)
    assert {(r["source"], r["batch"], r["path"].rsplit("/", 1)[1]) for r in listed.collect()} == {
        ("taxi", "0", "a.parquet"), ("taxi", "1", "b c.parquet"), ("weather", "0", "one.json")
    }


def test_a_changed_file_replaces_itself(spark, trips, tmp_path):
    folder, target, log = str(tmp_path / "raw"), str(tmp_path / "landed"), str(tmp_path / "log")
    sources = [SourceSpec("taxi", folder, "*.parquet", layout="rows")]
    write_file(trips({}, {}), folder, "a.parquet")
    land_new(spark, sources, target, log)
    time.sleep(1.1)
    trips({"fare_amount": 33.0}).coalesce(1).write.parquet(f"{folder}-new")
    (file,) = [f for f in os.listdir(f"{folder}-new") if f.endswith(".parquet")]
    os.replace(f"{folder}-new/{file}", f"{folder}/a.parquet")
    os.utime(f"{folder}/a.parquet")
    assert land_new(spark, sources, target, log) == {"taxi": 1}
    assert [r["fare_amount"] for r in read_bronze(spark, f"{target}/taxi").collect()] == [33.0]


def test_a_batch_run_twice_adds_nothing(spark, trips, tmp_path):
    folder, target = str(tmp_path / "raw"), str(tmp_path / "landed")
    source = SourceSpec("taxi", folder, "*.parquet", layout="rows")
    write_file(trips({}, {}), folder, "a.parquet")
    files = spark.read.format("binaryFile").load(folder).drop("content")
    for _ in range(2):
        assert landing.land_batch(files, "0", source, target) == 1
    assert read_bronze(spark, f"{target}/taxi").count() == 2
    assert landed_files(spark, target).count() == 1


def test_batches_of_bounded_size_and_missing_folders(spark, tmp_path):
    (tmp_path / "news").mkdir()
    for i in range(5):
        (tmp_path / "news" / f"{i}.xml").write_text(f"<rss>{i}</rss>")
    target = str(tmp_path / "landed")
    landed = land_new(spark, default_sources(str(tmp_path)), target, str(tmp_path / "log"), files_per_batch=2)
    assert landed == {"taxi": 0, "weather": 0, "news": 5}
    assert {r["batch"] for r in landed_files(spark, target).collect()} == {"0", "1", "2"}
    content = spark.read.parquet(f"{target}/news").select(F.decode("content", "UTF-8").alias("c"))
    assert sorted(r["c"] for r in content.collect()) == [f"<rss>{i}</rss>" for i in range(5)]


# copies


def made(trips, *days, note="a"):
    return trips(*[{"pickup_datetime": f"{d} 10:00:00", "dropoff_datetime": f"{d} 10:30:00", "note": note} for d in days])


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "landed"), str(tmp_path / "unique"), str(tmp_path / "log")


def run(spark, places, rows, delay="20 days"):
    folder, table, log = places
    rows.write.mode("append").parquet(folder)
    return unique_trips(spark, folder, rows.schema, table, log, delay)


def test_copies_across_runs_are_removed_however_late(spark, trips, places):
    first = run(spark, places, made(trips, "2024-01-01", "2024-01-02", "2024-01-02"))
    assert (first.rows_in, first.rows_out, first.late_rows, first.copies) == (3, 2, 0, 1)
    second = run(spark, places, made(trips, "2024-01-02", "2024-01-30", "2024-03-30"))
    assert (second.rows_in, second.rows_out, second.late_rows) == (3, 2, 0)
    # a late row that is new, twice, and a late copy
    late = made(trips, "2024-01-05", "2024-01-05", "2024-01-01")
    third = run(spark, places, late)
    assert third.late_rows == 3 and third.recovered_rows == 1 and third.rows_out == 1
    folder, table, _ = places
    schema = late.schema
    found = read_unique(spark, table, schema).select(late.columns)
    expected = spark.read.schema(schema).parquet(folder).distinct()
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    # once more, nothing is new
    empty = unique_trips(spark, folder, schema, table, places[2], "20 days")
    assert (empty.rows_in, empty.rows_out) == (0, 0)


def test_the_state_does_not_grow_with_the_rows(spark, trips, places):
    sizes = []
    for month in range(1, 9):
        days = [f"2024-{month:02d}-{day:02d}" for day in range(1, 29)]
        sizes.append(run(spark, places, made(trips, *days, *days), delay="10 days").rows_in_state)
    assert max(sizes[2:]) <= 2 * 28 and sizes[-1] <= sizes[2] + 5


def test_a_stopped_run_is_made_good(spark, trips, places, monkeypatch):
    run(spark, places, made(trips, "2024-01-01", "2024-06-01"))
    monkeypatch.setattr(copies, "recover", lambda *args: 1 / 0)
    late = made(trips, "2024-02-01", "2024-02-01")
    with pytest.raises(ZeroDivisionError):
        run(spark, places, late)
    monkeypatch.undo()
    folder, table, log = places
    assert read_unique(spark, table, late.schema).count() == 2
    done = unique_trips(spark, folder, late.schema, table, log, "20 days")
    assert done.recovered_rows == 1 and read_unique(spark, table, late.schema).count() == 3
    assert not os.path.exists(f"{table}/open")


def test_the_table_keeps_the_raw_columns_only(spark, trips, places):
    rows = made(trips, "2024-01-01", "2024-01-02")
    run(spark, places, rows)
    stored = spark.read.parquet(f"{places[1]}/rows").columns
    assert sorted(stored) == sorted([*rows.columns, "batch", "pickup_month"])
    found = read_unique(spark, places[1], rows.schema)
    assert found.columns == [*rows.columns, *copies.KEYS, copies.ARRIVED, copies.MONTH]
    keys = [r.asDict() for r in copies._keyed(rows).select(*copies.KEYS, copies.ARRIVED).collect()]
    read = [r.asDict() for r in found.select(*copies.KEYS, copies.ARRIVED).collect()]
    assert sorted(map(str, read)) == sorted(map(str, keys))


def test_only_rows_that_can_be_late_are_compared(spark, trips, places, monkeypatch):
    run(spark, places, made(trips, "2024-01-01", "2024-06-01"))
    compared, recover = [], copies.recover

    def watched(spark, raw, table, schema, until=None, *rest):
        compared.append(raw.where(F.col("pickup_datetime") <= until).count())
        return recover(spark, raw, table, schema, until, *rest)

    monkeypatch.setattr(copies, "recover", watched)
    days = [f"2024-07-{day:02d}" for day in range(1, 29)]
    done = run(spark, places, made(trips, "2024-02-01", "2024-02-01", "2024-01-01", *days).coalesce(1))
    assert compared == [3]  # none of the 28 that came on time
    assert (done.late_rows, done.recovered_rows, done.rows_out) == (3, 1, 29)


def test_late_rows_are_compared_a_few_months_at_a_time(spark, trips, places):
    run(spark, places, made(trips, "2024-01-01", "2024-03-01"))
    table = places[1]
    late = made(trips, *[f"2024-{month:02d}-01" for month in (1, 2, 2, 3, 4, 4, 5)], note="a")
    assert copies.recover(spark, late, table, late.schema, rows_at_once=3) == 3
    assert read_unique(spark, table, late.schema).count() == 5
    written = [p.name for p in Path(table, "rows").iterdir() if p.name.startswith("batch=late-")]
    assert len(written) == 3
    assert copies._month_groups([(2, 5), (1, 1), (3, 2), (4, 1)], 4) == [[1], [2], [3, 4]]


def test_batches_of_bounded_bytes_leave_no_shuffles(spark, trips, places):
    folder, table, log = places
    local = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    for month in (1, 3, 5, 2, 1):
        made(trips, *[f"2024-{month:02d}-{day:02d}" for day in range(1, 9)]).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    before = set(local.rglob("shuffle_*.data"))
    done = unique_trips(spark, folder, schema, table, log, "20 days", bytes_per_batch=1)
    until = time.time() + 10  # files are deleted in the background
    while (left := set(local.rglob("shuffle_*.data")) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert (done.rows_in, done.rows_out) == (40, 32)
    assert len([p for p in Path(table, "rows").iterdir() if p.name.startswith("batch=")]) >= 5
    assert read_unique(spark, table, schema).count() == 32
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_rows_without_a_time_and_keys_of_nulls(spark, trips, places):
    rows = trips({"pickup_datetime": None}, {"note": None}, {"tip_amount": None}, {"note": None})
    assert run(spark, places, rows).rows_out == 2
    keyed = copies.with_content_keys(spark.createDataFrame([(None, 1), (1, None), (None, 1)], "a int, b int"))
    assert keyed.select(*copies.KEYS).distinct().count() == 2


def test_reading_before_anything_was_written(spark, trips, tmp_path):
    assert read_unique(spark, str(tmp_path / "none"), trips({}).schema).count() == 0
    delete_folder(spark, str(tmp_path / "none"))


# samples


def test_samples_that_arrive_late_give_the_same_rates(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    from tripmart.operators.counters import counter_rate
    from tripmart.streaming.samples import counter_rates_so_far, settle_samples

    rng = random.Random(7)
    start = datetime(2024, 1, 1, 11, 50, tzinfo=timezone.utc)
    rows = [(start + timedelta(seconds=15 * i), "c", {"instance": "i"}, float(rng.randrange(50))) for i in range(600)]
    parts = [rows[:230] + rows[240:300], rows[230:240] + rows[300:450], rows[440:]]  # late and repeated ones
    folder, table, log = str(tmp_path / "in"), str(tmp_path / "settled"), str(tmp_path / "log")
    for part in parts:
        rng.shuffle(part)
        spark.createDataFrame(part, METRIC_SAMPLES).write.mode("append").parquet(folder)
        assert settle_samples(spark, folder, table, log, delay="20 minutes") == 0
    whole = counter_rate(spark.createDataFrame(rows, METRIC_SAMPLES), ("instance",))
    found = counter_rates_so_far(spark, table, ("instance",))
    last = found.agg(F.max("ts")).first()[0]
    expected = whole.where(F.col("ts") <= F.lit(last))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    # what is not yet settled is younger than the delay
    assert found.count() >= 600 - 20 * 4 - 1
