from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plans import plan_of
from tripmart.operators import kpis, views
from tripmart.operators.cleaning import clean
from tripmart.operators.kpis import CATALOGUE, kpi_cells, kpi_from_cells, kpi_table


@pytest.fixture
def silver(trips):
    return clean(
        trips(
            {},
            {"fare_amount": 30.0, "PULocationID": None, "payment_type": None},
            {"fare_amount": 31.0, "tip_amount": None, "total_amount": -4.0},
            {
                "pickup_datetime": "2024-03-09 05:00:00",
                "dropoff_datetime": "2024-03-09 05:10:00",
                "tip_amount": None,
                "payment_type": 2,
            },
        )
    )


@pytest.mark.parametrize("name", CATALOGUE)
def test_single_pass_equals_single_table(silver, name):
    direct, batch = kpi_table(silver, name), kpi_from_cells(kpi_cells(silver), name)
    assert direct.columns == batch.columns == CATALOGUE[name].columns
    assert direct.collect() == batch.collect()


@pytest.mark.parametrize("name", CATALOGUE)
def test_tables_have_the_declared_schema(silver, name):
    declared = [(f.name, f.dataType) for f in CATALOGUE[name].schema]
    assert [(f.name, f.dataType) for f in kpi_table(silver, name).schema] == declared
    assert [(f.name, f.dataType) for f in kpi_from_cells(kpi_cells(silver), name).schema] == declared


@pytest.mark.parametrize("name", CATALOGUE)
def test_keys_are_unique_and_trips_add_up(silver, name):
    table = kpi_table(silver, name)
    assert kpis.repeated_keys(table, name).count() == 0
    assert table.agg(F.sum("nb_trips")).first()[0] == 4


def test_null_codes_have_their_own_group(silver):
    payments = {r["payment_type"]: r["nb_trips"] for r in kpi_table(silver, "kpi_tip_by_payment").collect()}
    assert payments == {None: 1, 1: 2, 2: 1}
    assert kpi_table(silver, "kpi_tip_by_payment").first()["payment_type"] is None


def test_average_of_nulls_only_is_null(silver):
    tips = {r["payment_type"]: r["avg_tip"] for r in kpi_table(silver, "kpi_tip_by_payment").collect()}
    assert tips[2] is None and tips[1] == 2.0


@pytest.mark.parametrize("build", [kpi_table, lambda t, k: kpi_from_cells(kpi_cells(t), k)])
def test_summary_of_nothing_is_one_row(silver, build):
    rows = build(silver.limit(0), "kpi_global_summary").collect()
    assert [tuple(r) for r in rows] == [(None, 0, None, None, None)]


def test_ties_go_to_the_lowest_zone(trips):
    tied = clean(trips(*[{"PULocationID": zone} for zone in range(25, 0, -1)]))
    zones = [r["PULocationID"] for r in kpi_table(tied, "kpi_top_pickup_zones").collect()]
    assert zones == list(range(1, 21))
    shown = views.busiest_zones(kpi_table(tied, "kpi_top_pickup_zones"), "PULocationID")
    assert [r["PULocationID"] for r in shown.collect()] == [str(z) for z in range(15, 0, -1)]


def test_top_zones_use_a_top_k_plan_and_others_no_sort_before_a_sink(silver):
    assert "TakeOrderedAndProject" in plan_of(kpi_table(silver, "kpi_top_pickup_zones"))
    assert "rangepartitioning" in plan_of(kpi_table(silver, "kpi_price_by_hour"))
    assert "rangepartitioning" not in plan_of(kpi_table(silver, "kpi_price_by_hour", sort=False))


def test_single_pass_expands_five_times_only(silver):
    plan = plan_of(kpi_cells(silver), "simple")
    assert plan.count("Expand") == 1
    assert len(kpis.GRAINS) == 5


def test_display_order_is_kept(silver):
    days = views.price_by_weekday(kpi_table(silver, "kpi_price_by_day")).collect()
    assert [(r["pickup_dayofweek"], r["day_label"]) for r in days] == [(4, "Mer"), (7, "Sam")]
    months = views.monthly_series(kpi_table(silver, "kpi_monthly_stats")).collect()
    assert [r["period"] for r in months] == ["2024-03"]
    parts = views.week_and_weekend(kpi_table(silver, "kpi_weekday_vs_weekend")).collect()
    assert {r["label"]: r["nb_trips"] for r in parts} == {"Semaine": 3, "Week-end": 1}


def test_columns_come_from_the_catalogue():
    assert views.kpi_columns("kpi_daily_revenue") == ["pickup_date", "daily_revenue", "nb_trips"]
    assert CATALOGUE["kpi_daily_revenue"].schema["pickup_date"].dataType == T.DateType()
