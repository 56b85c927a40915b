"""Published versions of the clean table and of the KPI tables."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plans import plan_of
from tripmart.config import KpiSink
from tripmart.functions.numeric import interleaved
from tripmart.operators.cleaning import clean
from tripmart.operators.kpis import CATALOGUE
from tripmart.plans import silver as plan
from tripmart.plans.gold import write_gold
from tripmart.plans.silver import run_silver, run_silver_by_month, run_zone_layout
from tripmart.plans.study import PROFILE, VIEWS, run_profile, run_views
from tripmart.sinks import snapshots
from tripmart.sinks.snapshots import (
    NoSuchVersion,
    SnapshotConflict,
    abandon,
    changed_parts,
    expire,
    manifest,
    publish,
    read_version,
    start_run,
    versions,
    written_files,
)
from tripmart.sinks.tables import read_kpi, write_silver
from tripmart.sources.trips import read_silver

APRIL = {"pickup_datetime": "2024-04-02 10:00:00", "dropoff_datetime": "2024-04-02 10:30:00"}
MAY = {"pickup_datetime": "2024-05-02 10:00:00", "dropoff_datetime": "2024-05-02 10:30:00"}


def fares(df):
    return sorted((r["month"], r["fare_amount"]) for r in df.collect())


@pytest.fixture
def table(spark, trips, tmp_path):
    """March and April at 20, and a raw folder with March at 30 and May at 40."""
    trips({}, APRIL).write.parquet(str(tmp_path / "first"))
    trips({"fare_amount": 30.0}, MAY | {"fare_amount": 40.0}).write.parquet(str(tmp_path / "second"))
    silver = str(tmp_path / "silver")
    run_silver(spark, str(tmp_path / "first"), silver)
    return silver, str(tmp_path / "second")


def test_a_run_that_fails_half_way_changes_nothing(spark, table, monkeypatch):
    silver, second = table
    done = []

    def failing(*args, **kwargs):
        if done:
            raise RuntimeError("executor lost")
        done.append(write_silver(*args, **kwargs))
        return done[-1]

    monkeypatch.setattr(plan, "write_silver", failing)
    with pytest.raises(RuntimeError, match="executor lost"):
        run_silver(spark, second, silver, batch_bytes=1)
    assert done[0].rows == 1  # the first batch was written
    assert fares(read_silver(spark, silver)) == [(3, 20.0), (4, 20.0)]
    assert versions(spark, silver) == [1]
    monkeypatch.undo()
    run_silver(spark, second, silver, batch_bytes=1)
    assert fares(read_silver(spark, silver)) == [(3, 30.0), (5, 40.0)]
    assert versions(spark, silver) == [1, 2]


def test_a_reader_keeps_its_version(spark, table):
    silver, second = table
    before = read_silver(spark, silver)
    run_silver(spark, second, silver, replace_all=False)
    assert fares(before) == [(3, 20.0), (4, 20.0)]
    assert fares(read_silver(spark, silver)) == [(3, 30.0), (4, 20.0), (5, 40.0)]
    assert fares(read_silver(spark, silver, version=1)) == [(3, 20.0), (4, 20.0)]
    assert fares(read_silver(spark, silver, months=[(2024, 4)])) == [(4, 20.0)]
    changes = {r["part"]: r[1:] for r in changed_parts(spark, silver, 1, 2).collect()}
    assert changes == {
        "year=2024/month=3": ("replaced", 1, 1),
        "year=2024/month=5": ("added", 0, 1),
    }
    with pytest.raises(NoSuchVersion):
        read_silver(spark, silver, version=7)


def test_months_named_are_published_together(spark, table, trips, tmp_path):
    silver, second = table
    done = run_silver_by_month(spark, second, silver, [(2024, 3), (2024, 4), (2024, 3)])
    assert {m: r.rows_out for m, r in done.items()} == {(2024, 3): 1, (2024, 4): 0}
    assert versions(spark, silver) == [1, 2]
    assert fares(read_silver(spark, silver)) == [(3, 30.0)]  # April has no trip any more


def test_of_two_runs_from_one_version_one_is_refused(spark, table, trips):
    silver, _ = table
    runs = [start_run(spark, silver) for _ in range(2)]
    rows = clean(trips({"fare_amount": 50.0}))
    for run in runs:
        write_silver(rows, run.folder, replace_all=False)
    files = [written_files(spark, run, rows.schema) for run in runs]
    assert publish(spark, runs[0], files[0], {"": rows.schema}) == 2
    with pytest.raises(SnapshotConflict):
        publish(spark, runs[1], files[1], {"": rows.schema})
    abandon(spark, runs[1])
    assert versions(spark, silver) == [1, 2]
    assert fares(read_silver(spark, silver)) == [(3, 50.0)]


def test_old_versions_expire_with_the_files_that_only_they_name(spark, table, tmp_path):
    silver, second = table
    run_silver(spark, second, silver, replace_all=False)
    run_silver(spark, second, silver, replace_all=False)
    assert expire(spark, silver, keep=3) == []
    assert expire(spark, silver, keep=1) == [1, 2]
    assert versions(spark, silver) == [3]
    assert fares(read_silver(spark, silver)) == [(3, 30.0), (4, 20.0), (5, 40.0)]
    left = {str(p.parent.relative_to(tmp_path / "silver" / "data")) for p in (tmp_path / "silver" / "data").rglob("*.parquet")}
    assert len(left) == 3  # April of the first run, March and May of the last
    with pytest.raises(NoSuchVersion):
        read_silver(spark, silver, version=1)
    with pytest.raises(ValueError):
        expire(spark, silver, keep=0)


def test_manifest_has_rows_bytes_and_bounds(spark, table):
    silver, _ = table
    rows = {r["part"]: r for r in manifest(spark, silver).collect()}
    assert set(rows) == {"year=2024/month=3", "year=2024/month=4"}
    march = rows["year=2024/month=3"]
    assert march["nb_rows"] == 1 and march["nb_bytes"] > 0
    bounds = {name: tuple(span) for name, span in march["bounds"].items()}
    assert bounds["PULocationID"] == (10, 10, 0) and bounds["DOLocationID"] == (20, 20, 0)
    assert bounds["pickup_datetime"][0] == 1_709_719_200_000_000


def test_files_outside_the_bounds_are_not_opened(spark, trips, tmp_path):
    silver = str(tmp_path / "s")
    trips({}, APRIL | {"PULocationID": 77}, MAY | {"PULocationID": None}).write.parquet(str(tmp_path / "b"))
    run_silver(spark, str(tmp_path / "b"), silver)
    within = {"PULocationID": (50, 90)}
    (frame,) = read_version(spark, silver, within=within)
    assert len(frame.inputFiles()) == 1
    assert fares(read_silver(spark, silver, within=within)) == [(4, 20.0)]
    assert read_silver(spark, silver, within={"PULocationID": (11, 12)}).count() == 0
    with pytest.raises(ValueError, match="neither"):
        run = start_run(spark, silver)
        written_files(spark, run, read_silver(spark, silver).schema, ["fare_amount"])


def test_columns_that_differ_between_runs(spark, trips, tmp_path):
    silver = str(tmp_path / "s")
    trips({}).drop("note").write.parquet(str(tmp_path / "a"))
    trips(APRIL | {"note": "n"}).write.parquet(str(tmp_path / "b"))
    number = trips(MAY).withColumn("note", F.lit(5))
    number.write.parquet(str(tmp_path / "c"))
    for name in "abc":
        run_silver(spark, str(tmp_path / name), silver, replace_all=False)
    rows = read_silver(spark, silver).orderBy("month").collect()
    assert [r["note"] for r in rows] == [None, "n", "5"]
    assert "note" not in read_silver(spark, silver, months=[(2024, 3)]).columns


def test_reading_opens_no_footer_for_columns(spark, table, monkeypatch):
    silver, _ = table
    monkeypatch.setattr("tripmart.sources.trips._merged_schema", None)  # would be called to merge footers
    assert read_silver(spark, silver).count() == 2


def test_empty_versions(spark, trips, tmp_path):
    silver = str(tmp_path / "s")
    trips({"fare_amount": -1.0}).write.parquet(str(tmp_path / "b"))
    run_silver(spark, str(tmp_path / "b"), silver)
    assert read_silver(spark, silver).count() == 0 and "fare_amount" in read_silver(spark, silver).columns
    trips({}).write.parquet(str(tmp_path / "c"))
    run_silver(spark, str(tmp_path / "c"), silver, replace_all=False)
    run_silver(spark, str(tmp_path / "b"), silver, replace_all=False)  # empties March again
    assert [read_silver(spark, silver, version=v).count() for v in (1, 2, 3)] == [0, 1, 0]


def test_a_plain_table_is_not_overwritten_in_part(spark, trips, tmp_path):
    silver = str(tmp_path / "s")
    write_silver(clean(trips({}, APRIL)), silver)
    trips({}).write.parquet(str(tmp_path / "b"))
    with pytest.raises(ValueError, match="without versions"):
        run_silver(spark, str(tmp_path / "b"), silver, replace_all=False)
    with pytest.raises(NoSuchVersion):
        read_silver(spark, silver, version=1)
    assert read_silver(spark, silver).count() == 2


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_kpi_tables_of_a_run_appear_together(spark, trips, tmp_path, monkeypatch, kind):
    sink = KpiSink(kind=kind, path=str(tmp_path / "g"), versioned=True)
    silver = clean(trips({}, {"PULocationID": None}, APRIL))
    assert set(write_gold(silver, sink)) == set(CATALOGUE)
    daily = CATALOGUE["kpi_daily_revenue"]
    before = read_kpi(spark, daily, sink)
    written = []

    def failing(table, kpi, to):
        if kpi.name == "kpi_monthly_stats":
            raise RuntimeError("disk full")
        written.append(kpi.name)
        return 0

    monkeypatch.setattr("tripmart.plans.gold.write_kpi", failing)
    with pytest.raises(RuntimeError, match="disk full"):
        write_gold(silver.where("month = 4"), sink)
    monkeypatch.undo()
    assert versions(spark, sink.path) == [1] and read_kpi(spark, daily, sink).count() == 2
    write_gold(silver.where("month = 4"), sink)
    assert read_kpi(spark, daily, sink).count() == 1 and before.count() == 2
    assert read_kpi(spark, daily, sink, version=1).count() == 2
    sizes = {r["part"]: r["nb_rows"] for r in manifest(spark, sink.path).collect()}
    assert sizes["kpi_daily_revenue"] == 1


def test_only_files_have_versions():
    with pytest.raises(ValueError, match="no versions"):
        KpiSink(kind="table", versioned=True)
    assert not replace(KpiSink(path="p", versioned=True), versioned=False).versioned


def test_names_of_parts():
    assert snapshots.part_name(year=2024, month=3) == "year=2024/month=3"


def test_pinned_months_are_the_only_folders_listed(spark, table):
    silver, _ = table
    march = read_silver(spark, silver, months=[(2024, 3)])
    assert "month=4" not in plan_of(march) and len(march.inputFiles()) == 1


@pytest.mark.parametrize("scattered", [True, False])
def test_scattered_rows_are_dealt_to_the_batches_once(spark, trips, tmp_path, monkeypatch, scattered):
    months = [{"pickup_datetime": f"2024-{m:02d}-02 10:00:00", "dropoff_datetime": f"2024-{m:02d}-02 10:30:00"} for m in range(1, 8)]
    rows = [*months, months[2], {"pickup_datetime": None}]
    for part in [rows] if scattered else [[r] for r in rows]:
        trips(*part).coalesce(1).write.mode("append").parquet(str(tmp_path / "b"))
    dealt = []
    by_batch = plan._by_batch
    monkeypatch.setattr(plan, "_by_batch", lambda *a: dealt.append(a[2]) or by_batch(*a))
    run_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), batch_bytes=1)
    run_silver(spark, str(tmp_path / "b"), str(tmp_path / "whole"))
    found, whole = (sorted(map(str, read_silver(spark, str(tmp_path / n)).collect())) for n in ("s", "whole"))
    assert found == whole and len(found) == 7
    assert len(dealt) == scattered and not any(Path(folder).exists() for folder in dealt)


# lookups by zone


def test_zone_layout_keeps_the_rows_and_opens_few_files(spark, trips, tmp_path):
    silver = str(tmp_path / "s")
    rows = [
        {"PULocationID": z, "DOLocationID": (z * 7) % 64, "fare_amount": 10.0 + z, "pickup_datetime": f"2024-03-{1 + z % 28:02d} 10:00:00",
         "dropoff_datetime": f"2024-03-{1 + z % 28:02d} 10:30:00"}
        for z in range(64)
    ]
    trips(*rows, {"PULocationID": None}, APRIL).write.parquet(str(tmp_path / "b"))
    run_silver(spark, str(tmp_path / "b"), silver)
    before = read_silver(spark, silver)
    assert run_zone_layout(spark, silver, [(2024, 3)], rows_per_file=5) == 65
    after = read_silver(spark, silver)
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect()))
    files = manifest(spark, silver).where("part = 'year=2024/month=3'").count()
    (found,) = read_version(spark, silver, within={"PULocationID": (17, 17)})
    assert files >= 13 and len(found.inputFiles()) <= files / 3
    looked_up = read_silver(spark, silver, within={"PULocationID": (17, 17)})
    assert [r["fare_amount"] for r in looked_up.collect()] == [27.0]
    assert {r["change"] for r in changed_parts(spark, silver, 1, 2).collect()} == {"replaced"}


def test_small_files_of_a_layout_share_a_task(spark, trips, tmp_path):
    silver = str(tmp_path / "s")
    trips(*[{"PULocationID": z, "fare_amount": 10.0 + z} for z in range(40)]).write.parquet(str(tmp_path / "b"))
    run_silver(spark, str(tmp_path / "b"), silver)
    assert run_zone_layout(spark, silver, rows_per_file=5) == 40
    (found,) = read_version(spark, silver)
    files = [Path(f.removeprefix("file:")) for f in found.inputFiles()]
    assert len(files) == 8 and len({f.name.split("-")[1] for f in files}) == 1
    # a bloom filter is as large as so few rows need
    assert max(f.stat().st_size for f in files) < 20_000


def test_layout_needs_versions(spark, trips, tmp_path):
    write_silver(clean(trips({})), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="without versions"):
        run_zone_layout(spark, str(tmp_path / "s"))


def test_interleaved_bits(spark):
    rows = [(0, 0), (1, 0), (0, 1), (5, 3), (65535, 65535), (70000, -4), (None, 2)]
    df = spark.createDataFrame(rows, "a long, b long").select(interleaved(F.col("a"), F.col("b")).alias("m"))

    def direct(a, b):
        a, b = (min(max(v or 0, 0), 65535) for v in (a, b))
        return sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(16))

    assert [r["m"] for r in df.collect()] == [direct(*r) for r in rows]


# the study and the presentation tables


def test_study_and_views_are_written(spark, trips, tmp_path):
    silver, gold = str(tmp_path / "s"), KpiSink(path=str(tmp_path / "g"), versioned=True)
    write_silver(clean(trips({}, {"fare_amount": 21.0, "total_amount": 30.0}, APRIL)), silver)
    counts = run_profile(spark, silver, KpiSink(path=str(tmp_path / "p")))
    assert set(counts) == set(PROFILE) and counts["profile_trips_by_hour"] >= 1
    assert spark.read.parquet(str(tmp_path / "p" / "profile_describe")).count() == counts["profile_describe"] == 8
    write_gold(read_silver(spark, silver), gold)
    shown = run_views(spark, gold, KpiSink(kind="json", path=str(tmp_path / "v")))
    assert set(shown) == set(VIEWS) and shown["view_revenue_series"] == 2
    assert spark.read.json(str(tmp_path / "v" / "view_monthly_series")).count() == 2
