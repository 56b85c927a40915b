"""The tables of the exploratory study and the presentation tables, written as a job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.config import KpiSink
from tripmart.operators import profiling, views
from tripmart.operators.kpis import CATALOGUE
from tripmart.sinks.tables import read_kpi, write_kpi
from tripmart.sources.trips import read_silver

# columns that the study shows the distribution of
SHOWN = ("total_amount", "trip_distance")

PROFILE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "profile_describe": profiling.describe,
    "profile_column_info": profiling.column_info,
    "profile_missing_values": profiling.missing_values,
    "profile_box_statistics": lambda trips: profiling.box_statistics(trips, SHOWN),
    "profile_trips_by_hour": lambda trips: profiling.counts_by(trips, "pickup_hour"),
    "profile_trips_by_weekday": profiling.counts_by_weekday,
    "profile_price_by_hour": lambda trips: profiling.mean_by(trips, "pickup_hour", "total_amount"),
    "profile_top_pickup_zones": lambda trips: profiling.top_values(trips, "PULocationID"),
    "profile_correlations": profiling.correlation_matrix,
}
for _column in SHOWN:
    PROFILE[f"profile_histogram_{_column}"] = lambda trips, c=_column: profiling.histogram(trips, c)
    PROFILE[f"profile_density_{_column}"] = lambda trips, c=_column: profiling.density(trips, c)

# presentation table: the KPI it is made from, and how
VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "view_revenue_series": ("kpi_daily_revenue", views.revenue_series),
    "view_busiest_pickup_zones": ("kpi_top_pickup_zones", lambda z: views.busiest_zones(z, "PULocationID")),
    "view_busiest_dropoff_zones": ("kpi_top_dropoff_zones", lambda z: views.busiest_zones(z, "DOLocationID")),
    "view_price_by_hour": ("kpi_price_by_hour", views.price_by_hour),
    "view_price_by_weekday": ("kpi_price_by_day", views.price_by_weekday),
    "view_week_and_weekend": ("kpi_weekday_vs_weekend", views.week_and_weekend),
    "view_tip_by_payment": ("kpi_tip_by_payment", views.tip_by_payment),
    "view_monthly_series": ("kpi_monthly_stats", views.monthly_series),
}


def run_profile(spark: SparkSession, silver: str, sink: KpiSink) -> dict[str, int]:
    """Write the tables of the study over the whole clean table; rows by table.

    The tables are small, whatever the number of trips. Each reads the columns it needs.
    """
    trips = read_silver(spark, silver)
    return {name: write_kpi(build(trips), name, sink) for name, build in PROFILE.items()}


def run_views(spark: SparkSession, gold: KpiSink, sink: KpiSink) -> dict[str, int]:
    """Write the presentation tables of the KPI tables; rows by table."""
    return {
        name: write_kpi(build(read_kpi(spark, CATALOGUE[kpi], gold)), name, sink)
        for name, (kpi, build) in VIEWS.items()
    }
