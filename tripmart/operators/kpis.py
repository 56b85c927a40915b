"""The KPI catalogue and the two ways to compute it: one table, or all in one pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schema import SILVER


@dataclass(frozen=True)
class Measure:
    """An output column: an average, a sum, or the number of trips."""

    name: str
    function: str  # avg | sum | count
    column: str | None = None

    def direct(self) -> Column:
        """The measure over trips."""
        if self.function == "count":
            return F.count("*").alias(self.name)
        return getattr(F, self.function)(self.column).alias(self.name)

    def parts(self) -> dict[str, Column]:
        """Sums and counts over trips from which any coarser grouping can be finished."""
        if self.function == "count":
            return {"rows": F.count("*")}
        column = self.column
        return {f"sum_{column}": F.sum(column), f"values_{column}": F.count(column)}

    def from_parts(self) -> Column:
        """The measure over such sums and counts."""
        if self.function == "count":
            return F.coalesce(F.sum("rows"), F.lit(0)).alias(self.name)
        total = F.sum(f"sum_{self.column}")
        if self.function == "sum":
            return total.alias(self.name)
        return F.try_divide(total, F.sum(f"values_{self.column}")).alias(self.name)


@dataclass(frozen=True)
class Kpi:
    """A KPI table: what it groups by, what it measures, and which rows it keeps."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    ordered: bool = True  # by the keys, ascending
    top: int | None = None  # only the most frequent keys

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.schema]

    @property
    def schema(self) -> T.StructType:
        key_types = {f.name: f.dataType for f in SILVER} | {"pickup_date": T.DateType()}
        measure_types = {"avg": T.DoubleType(), "sum": T.DoubleType(), "count": T.LongType()}
        return T.StructType(
            [T.StructField(key, key_types[key]) for key in self.keys]
            + [T.StructField(m.name, measure_types[m.function]) for m in self.measures]
        )


TRIPS = Measure("nb_trips", "count")
AVG_PRICE = Measure("avg_price", "avg", "total_amount")
AVG_TIP = Measure("avg_tip", "avg", "tip_amount")
AVG_DISTANCE = Measure("avg_distance", "avg", "trip_distance")
AVG_DURATION = Measure("avg_duration_minutes", "avg", "trip_duration_minutes")
REVENUE = Measure("daily_revenue", "sum", "total_amount")
TOP_ZONES = 20

# fixed values: table, key and column names
CATALOGUE: dict[str, Kpi] = {
    kpi.name: kpi
    for kpi in (
        Kpi(
            "kpi_global_summary",
            (),
            (AVG_PRICE, TRIPS, AVG_DISTANCE, AVG_DURATION, AVG_TIP),
        ),
        Kpi("kpi_daily_revenue", ("pickup_date",), (REVENUE, TRIPS)),
        Kpi("kpi_top_pickup_zones", ("PULocationID",), (TRIPS, AVG_PRICE), top=TOP_ZONES),
        Kpi("kpi_top_dropoff_zones", ("DOLocationID",), (TRIPS, AVG_PRICE), top=TOP_ZONES),
        Kpi("kpi_price_by_hour", ("pickup_hour",), (AVG_PRICE, TRIPS)),
        Kpi("kpi_price_by_day", ("pickup_dayofweek",), (AVG_PRICE, TRIPS)),
        Kpi("kpi_weekday_vs_weekend", ("is_weekend",), (AVG_PRICE, TRIPS, AVG_TIP), ordered=False),
        Kpi("kpi_tip_by_payment", ("payment_type",), (AVG_TIP, TRIPS)),
        Kpi("kpi_monthly_stats", ("year", "month"), (AVG_DISTANCE, AVG_DURATION, TRIPS)),
    )
}

# Groupings of the single pass. The calendar columns all follow from the date, so one grouping
# by day serves the five KPIs on them and the total; codes that vary freely get their own.
GRAINS: tuple[tuple[str, ...], ...] = (
    ("pickup_date", "pickup_dayofweek", "is_weekend", "year", "month"),
    ("pickup_hour",),
    ("payment_type",),
    ("PULocationID",),
    ("DOLocationID",),
)


def with_pickup_date(trips: DataFrame) -> DataFrame:
    return trips.withColumn("pickup_date", F.to_date("pickup_datetime"))


def top_by_count(df: DataFrame, key: str, limit: int, count: str = "nb_trips") -> DataFrame:
    """The most frequent keys; among equal counts the lowest key comes first."""
    return df.orderBy(F.desc(count), F.asc_nulls_first(key)).limit(limit)


def _arrange(df: DataFrame, kpi: Kpi, sort: bool) -> DataFrame:
    if kpi.top is not None:
        return top_by_count(df, kpi.keys[0], kpi.top)
    if sort and kpi.ordered and kpi.keys:
        return df.orderBy(*kpi.keys)
    return df


def kpi_table(trips: DataFrame, kpi: Kpi | str, sort: bool = True) -> DataFrame:
    """One KPI. ``sort=False`` leaves out the display order, which a sink does not keep."""
    kpi = CATALOGUE[kpi] if isinstance(kpi, str) else kpi
    source = trips.transform(with_pickup_date) if "pickup_date" in kpi.keys else trips
    table = source.groupBy(*kpi.keys).agg(*[m.direct() for m in kpi.measures])
    return _arrange(table, kpi, sort)


# month of the trips that a cell sums, where cells are kept by month
CELL_MONTH = ("cell_year", "cell_month")


def kpi_cells(
    trips: DataFrame, kpis: Iterable[Kpi] = CATALOGUE.values(), by_month: bool = False
) -> DataFrame:
    """Sums and counts of all KPIs at the ``GRAINS``, from one scan of the trips.

    The result has a row per day, hour, payment type and zone: its size follows the number of
    distinct keys, not the number of trips. ``by_month`` keeps the cells of each month apart, with
    the month in ``CELL_MONTH``, so that a month can be replaced.
    """
    dims = [name for grain in GRAINS for name in grain]
    parts = {name: part for kpi in kpis for m in kpi.measures for name, part in m.parts().items()}
    inputs = {m.column for kpi in kpis for m in kpi.measures if m.column}
    months = list(CELL_MONTH) if by_month else []
    parted = trips.withColumns(dict(zip(CELL_MONTH, (F.col("year"), F.col("month")))))
    dated = parted.transform(with_pickup_date).select(*months, *dims, *sorted(inputs))
    # the month is in every grouping and comes first, so it leaves the grouping number as it is
    sets = [[dated[d] for d in (*months, *grain)] for grain in GRAINS]
    return dated.groupingSets(sets, *months, *dims).agg(
        F.grouping_id().cast("int").alias("grain"),
        *[part.alias(name) for name, part in parts.items()],
    )


def _grain_of(keys: tuple[str, ...]) -> tuple[str, ...]:
    return next(grain for grain in GRAINS if set(keys) <= set(grain))


def _grain_id(grain: tuple[str, ...]) -> int:
    """``grouping_id`` of a grain: a bit for each dimension, set where it is summed over."""
    dims = [name for g in GRAINS for name in g]
    return int("".join("0" if name in grain else "1" for name in dims), 2)


def kpi_from_cells(cells: DataFrame, kpi: Kpi | str, sort: bool = True) -> DataFrame:
    """One KPI from the cells of ``kpi_cells``; equal to ``kpi_table`` over the trips."""
    kpi = CATALOGUE[kpi] if isinstance(kpi, str) else kpi
    rows = cells.where(F.col("grain") == _grain_id(_grain_of(kpi.keys)))
    table = rows.groupBy(*kpi.keys).agg(*[m.from_parts() for m in kpi.measures])
    return _arrange(table, kpi, sort)


def repeated_keys(table: DataFrame, kpi: Kpi | str) -> DataFrame:
    """Keys that occur more than once in a KPI table; empty for a sound one."""
    kpi = CATALOGUE[kpi] if isinstance(kpi, str) else kpi
    counted = table.groupBy(*kpi.keys).agg(F.count("*").alias("nb_rows"))
    return counted.where(F.col("nb_rows") > 1)
