"""KPI tables, their sinks, and the presentation tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs
from checks.registry import check
from checks.sql import SILVER
from tripmart.config import KpiSink, scratch_path
from tripmart.operators import views
from tripmart.operators.cleaning import clean
from tripmart.operators.kpis import (
    CATALOGUE,
    kpi_cells,
    kpi_from_cells,
    kpi_table,
    repeated_keys,
    top_by_count,
)
from tripmart.plans.gold import run_gold, write_gold
from tripmart.sinks.tables import read_kpi, write_kpi, write_silver
from tripmart.sources.documents import export_documents, read_kpi_export, typed_documents
from tripmart.sources.trips import read_silver, union_by_name

_TOP = "ORDER BY nb_trips DESC, {key} NULLS FIRST LIMIT {limit}"

KPI_SQL = {
    "kpi_global_summary": """
      SELECT avg(total_amount) AS avg_price, count(*) AS nb_trips,
        avg(trip_distance) AS avg_distance,
        avg(trip_duration_minutes) AS avg_duration_minutes, avg(tip_amount) AS avg_tip
      FROM silver""",
    "kpi_daily_revenue": """
      SELECT CAST(pickup_datetime AS DATE) AS pickup_date, sum(total_amount) AS daily_revenue,
        count(*) AS nb_trips
      FROM silver GROUP BY 1""",
    "kpi_top_pickup_zones": f"""
      SELECT PULocationID, count(*) AS nb_trips, avg(total_amount) AS avg_price
      FROM silver GROUP BY 1 {_TOP.format(key='PULocationID', limit=20)}""",
    "kpi_top_dropoff_zones": f"""
      SELECT DOLocationID, count(*) AS nb_trips, avg(total_amount) AS avg_price
      FROM silver GROUP BY 1 {_TOP.format(key='DOLocationID', limit=20)}""",
    "kpi_price_by_hour": """
      SELECT pickup_hour, avg(total_amount) AS avg_price, count(*) AS nb_trips
      FROM silver GROUP BY 1""",
    "kpi_price_by_day": """
      SELECT pickup_dayofweek, avg(total_amount) AS avg_price, count(*) AS nb_trips
      FROM silver GROUP BY 1""",
    "kpi_weekday_vs_weekend": """
      SELECT is_weekend, avg(total_amount) AS avg_price, count(*) AS nb_trips,
        avg(tip_amount) AS avg_tip
      FROM silver GROUP BY 1""",
    "kpi_tip_by_payment": """
      SELECT payment_type, avg(tip_amount) AS avg_tip, count(*) AS nb_trips
      FROM silver GROUP BY 1""",
    "kpi_monthly_stats": """
      SELECT year, month, avg(trip_distance) AS avg_distance,
        avg(trip_duration_minutes) AS avg_duration_minutes, count(*) AS nb_trips
      FROM silver GROUP BY 1, 2""",
}


def _register(name: str, sql: str) -> None:
    @check(name, f"WITH {SILVER} {sql}")
    def one_kpi(spark, sf_dir):
        return kpi_table(inputs.silver_trips(spark, sf_dir), name)

    @check(name.replace("kpi_", "kpi_single_pass_"), f"WITH {SILVER} {sql}")
    def from_single_pass(spark, sf_dir):
        return kpi_from_cells(kpi_cells(inputs.silver_trips(spark, sf_dir)), name)


for _name, _sql in KPI_SQL.items():
    _register(_name, _sql)


@check(
    "kpi_repeated_keys",
    f"""WITH {SILVER}
    SELECT payment_type, count(*) AS nb_rows
    FROM (SELECT payment_type, is_weekend FROM silver GROUP BY ALL)
    GROUP BY 1 HAVING count(*) > 1""",
)
def kpi_repeated_keys(spark, sf_dir):
    """A table that is finer than its key, so that keys do repeat."""
    finer = inputs.silver_trips(spark, sf_dir).groupBy("payment_type", "is_weekend").count()
    return repeated_keys(finer, "kpi_tip_by_payment")


@check(
    "gold_job_counts",
    f"WITH {SILVER} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS kpi, count(*) AS nb_rows FROM ({sql})" for name, sql in KPI_SQL.items()
    ),
)
def gold_job_counts(spark, sf_dir):
    """The job that writes all KPI tables, and the size of what it wrote."""
    sink = KpiSink(path=scratch_path(spark, "gold"))
    write_gold(inputs.stored_silver(spark, sf_dir), sink)
    sizes = [
        read_kpi(spark, kpi, sink).agg(F.count("*").alias("nb_rows")).withColumn("kpi", F.lit(name))
        for name, kpi in CATALOGUE.items()
    ]
    return union_by_name(sizes).select("kpi", "nb_rows")


def _refreshed(spark, sf_dir):
    """All months stored as cells with one month wrong, then that month refreshed."""
    silver, old, cells = (scratch_path(spark, n) for n in ("silver", "silver", "cells"))
    write_silver(clean(inputs.bronze_trips(spark, sf_dir), by_time=True), silver, True, True)
    trips = read_silver(spark, silver)  # cleaned once
    inputs.write_months(trips.where("month <> 4 OR total_amount > 50"), old)
    sink = KpiSink(path=scratch_path(spark, "gold"))
    run_gold(spark, old, sink, cells=cells)
    aprils = [(r[0], 4) for r in trips.select("year").distinct().collect()]
    run_gold(spark, silver, sink, months=aprils, cells=cells)
    return sink


for _name in ("kpi_daily_revenue", "kpi_top_pickup_zones", "kpi_monthly_stats"):

    @check(f"gold_incremental_{_name[4:]}", f"WITH {SILVER} {KPI_SQL[_name]}")
    def gold_incremental(spark, sf_dir, name=_name):
        return read_kpi(spark, CATALOGUE[name], _refreshed(spark, sf_dir))


@check("kpi_sink_parquet", f"WITH {SILVER} {KPI_SQL['kpi_daily_revenue']}")
def kpi_sink_parquet(spark, sf_dir):
    kpi = CATALOGUE["kpi_daily_revenue"]
    sink = KpiSink(path=scratch_path(spark, "gold"))
    write_kpi(kpi_table(inputs.silver_trips(spark, sf_dir), kpi, sort=False), kpi, sink)
    return read_kpi(spark, kpi, sink)


def _two_kpi_versions(spark, sf_dir) -> KpiSink:
    """KPIs of all trips, and then of card payments only."""
    sink = KpiSink(path=scratch_path(spark, "gold"), versioned=True)
    trips = inputs.stored_silver(spark, sf_dir)
    write_gold(trips, sink)
    write_gold(trips.where("payment_type = 1"), sink)
    return sink


@check("kpi_snapshot_as_of", f"WITH {SILVER} {KPI_SQL['kpi_daily_revenue']}")
def kpi_snapshot_as_of(spark, sf_dir):
    sink = _two_kpi_versions(spark, sf_dir)
    return read_kpi(spark, CATALOGUE["kpi_daily_revenue"], sink, version=1)


@check(
    "kpi_snapshot_newest",
    f"WITH {SILVER.replace('silver AS', 'all_trips AS')}, silver AS (SELECT * FROM all_trips WHERE payment_type = 1) "
    + KPI_SQL["kpi_monthly_stats"],
)
def kpi_snapshot_newest(spark, sf_dir):
    return read_kpi(spark, CATALOGUE["kpi_monthly_stats"], _two_kpi_versions(spark, sf_dir))


@check("kpi_sink_json", f"WITH {SILVER} {KPI_SQL['kpi_monthly_stats']}")
def kpi_sink_json(spark, sf_dir):
    kpi = CATALOGUE["kpi_monthly_stats"]
    sink = KpiSink(kind="json", path=scratch_path(spark, "gold"))
    write_kpi(kpi_table(inputs.silver_trips(spark, sf_dir), kpi, sort=False), kpi, sink)
    return read_kpi(spark, kpi, sink)


@check(
    "kpi_export_of_drifting_documents",
    f"""WITH {SILVER}, kpi AS ({KPI_SQL['kpi_daily_revenue']})
    SELECT CAST(pickup_date AS DATE) AS pickup_date, daily_revenue,
      CASE WHEN day(pickup_date) % 5 <> 0 THEN nb_trips END AS nb_trips,
      CASE WHEN day(pickup_date) % 5 = 0 THEN 'nb_trips' ELSE '' END AS unread
    FROM kpi""",
)
def kpi_export_of_drifting_documents(spark, sf_dir):
    """Documents whose fields are numbers, texts or wrapped values, and some that are no number at all."""
    daily = kpi_table(inputs.silver_trips(spark, sf_dir), "kpi_daily_revenue", sort=False)
    day, text = F.date_format("pickup_date", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.col("daily_revenue").cast("string")
    month = F.day("pickup_date")
    revenue = F.when(month % 3 == 0, F.to_json(F.struct(F.col("daily_revenue").alias("v")))).when(
        month % 3 == 1, F.to_json(F.struct(text.alias("v")))
    ).otherwise(F.to_json(F.struct(F.struct(text.alias("$numberDouble")).alias("v"))))
    trips = F.when(month % 5 == 0, F.lit('{"v":"many"}')).otherwise(
        F.to_json(F.struct(F.struct(F.col("nb_trips").cast("string").alias("$numberLong")).alias("v")))
    )
    date = F.when(month % 2 == 0, F.to_json(F.struct(F.struct(day.alias("$date")).alias("v")))).otherwise(
        F.to_json(F.struct(day.alias("v")))
    )

    def field(name, wrapped):  # the value of {"v":value}
        return F.concat(F.lit(f'"{name}":'), F.substr(wrapped, F.lit(6), F.length(wrapped) - 6))

    path = scratch_path(spark, "export")
    parts = [field("pickup_date", date), field("daily_revenue", revenue), field("nb_trips", trips)]
    daily.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value")).write.text(path)
    schema = T.StructType.fromDDL("pickup_date date, daily_revenue double, nb_trips bigint")
    found = typed_documents(export_documents(spark, path), schema)
    return found.drop("file_name").withColumn("unread", F.array_join("unread", ","))


@check(
    "kpi_export_revenue_series",
    f"""WITH {SILVER}
    SELECT CAST(pickup_datetime AS DATE) AS pickup_date, sum(total_amount) AS daily_revenue
    FROM silver GROUP BY 1""",
)
def kpi_export_revenue_series(spark, sf_dir):
    """Exported documents with nested ids and dates, read back and flattened."""
    daily = kpi_table(inputs.silver_trips(spark, sf_dir), "kpi_daily_revenue", sort=False)
    day = F.date_format("pickup_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    documents = daily.select(
        F.struct(F.date_format("pickup_date", "yyyyMMdd").alias("$oid")).alias("_id"),
        F.struct(day.alias("$date")).alias("pickup_date"),
        "daily_revenue",
        "nb_trips",
    )
    path = scratch_path(spark, "export")
    array = documents.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    array.write.text(path)
    return views.revenue_series(read_kpi_export(spark, path))


@check(
    "top_15_of_zones",
    f"""WITH {SILVER}
    SELECT DOLocationID, count(*) AS nb_trips FROM silver GROUP BY 1
    {_TOP.format(key='DOLocationID', limit=15)}""",
)
def top_15_of_zones(spark, sf_dir):
    trips = inputs.silver_trips(spark, sf_dir)
    counted = trips.groupBy("DOLocationID").agg(F.count("*").alias("nb_trips"))
    return top_by_count(counted, "DOLocationID", 15)


@check("view_global_summary", f"WITH {SILVER} {KPI_SQL['kpi_global_summary']}")
def view_global_summary(spark, sf_dir):
    return kpi_table(inputs.silver_trips(spark, sf_dir), "kpi_global_summary")


def _view(name: str, kpi: str, sql: str):
    def register(build):
        @check(name, f"WITH {SILVER}, kpi AS ({KPI_SQL[kpi]}) {sql}")
        def view(spark, sf_dir):
            return build(kpi_table(inputs.silver_trips(spark, sf_dir), kpi, sort=False))

        return build

    return register


_view(
    "view_revenue_series", "kpi_daily_revenue", "SELECT pickup_date, daily_revenue FROM kpi"
)(views.revenue_series)

for _end, _key in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
    _view(
        f"view_busiest_{_end}_zones",
        f"kpi_top_{_end}_zones",
        f"""SELECT CAST({_key} AS VARCHAR) AS {_key}, nb_trips
        FROM (SELECT * FROM kpi {_TOP.format(key=_key, limit=15)})""",
    )(lambda zones, key=_key: views.busiest_zones(zones, key))

_view("view_price_by_hour", "kpi_price_by_hour", "SELECT pickup_hour, avg_price FROM kpi")(
    views.price_by_hour
)
_view(
    "view_price_by_weekday",
    "kpi_price_by_day",
    """SELECT pickup_dayofweek, ['Dim', 'Lun', 'Mar', 'Mer', 'Jeu', 'Ven', 'Sam'][pickup_dayofweek]
      AS day_label, avg_price FROM kpi""",
)(views.price_by_weekday)
_view(
    "view_week_and_weekend",
    "kpi_weekday_vs_weekend",
    """SELECT CASE WHEN is_weekend THEN 'Week-end' ELSE 'Semaine' END AS label, avg_price, nb_trips
    FROM kpi""",
)(views.week_and_weekend)
_view(
    "view_tip_by_payment",
    "kpi_tip_by_payment",
    "SELECT CAST(payment_type AS VARCHAR) AS payment_type, avg_tip FROM kpi",
)(views.tip_by_payment)
_view(
    "view_monthly_series",
    "kpi_monthly_stats",
    """SELECT printf('%d-%02d', year, month) AS period, avg_distance, avg_duration_minutes
    FROM kpi""",
)(views.monthly_series)
