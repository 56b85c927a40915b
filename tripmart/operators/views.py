"""Presentation tables: KPI tables sorted, trimmed and labelled for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.labels import category, weekday_label, weekend_label
from tripmart.functions.temporal import iso_timestamp, period_label
from tripmart.operators.kpis import CATALOGUE, top_by_count

TOP_SHOWN = 15


def revenue_series(daily: DataFrame) -> DataFrame:
    """Revenue by day; the day may also be the text of a document export."""
    exported = "pickup_date.$date"
    if exported in daily.columns:
        day = iso_timestamp(F.col(f"`{exported}`").cast("string")).cast("date")
        daily = daily.withColumn("pickup_date", day)
    return daily.select("pickup_date", "daily_revenue").orderBy("pickup_date")


def busiest_zones(zones: DataFrame, key: str, limit: int = TOP_SHOWN) -> DataFrame:
    """The busiest zones, least busy first, with the zone as text."""
    shown = top_by_count(zones, key, limit).orderBy("nb_trips", F.desc_nulls_last(key))
    return shown.select(category(F.col(key)).alias(key), "nb_trips")


def price_by_hour(hours: DataFrame) -> DataFrame:
    return hours.select("pickup_hour", "avg_price").orderBy("pickup_hour")


def price_by_weekday(days: DataFrame) -> DataFrame:
    label = weekday_label(F.col("pickup_dayofweek")).alias("day_label")
    return days.select("pickup_dayofweek", label, "avg_price").orderBy("pickup_dayofweek")


def week_and_weekend(parts: DataFrame) -> DataFrame:
    return parts.select(
        weekend_label(F.col("is_weekend")).alias("label"), "avg_price", "nb_trips"
    )


def tip_by_payment(payments: DataFrame) -> DataFrame:
    ordered = payments.orderBy("payment_type")
    return ordered.select(category(F.col("payment_type")).alias("payment_type"), "avg_tip")


def monthly_series(months: DataFrame) -> DataFrame:
    period = period_label(F.col("year"), F.col("month")).alias("period")
    return months.orderBy("year", "month").select(
        period, "avg_distance", "avg_duration_minutes"
    )


def kpi_columns(name: str) -> list[str]:
    """The columns of a KPI table, from the catalogue; no data is read."""
    return CATALOGUE[name].columns
