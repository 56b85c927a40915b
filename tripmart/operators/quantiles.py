"""Exact quantiles of many columns without sorting or shuffling the rows.

The built-in exact ``percentile`` gathers all distinct values of a column in one task. Here each
wanted rank is narrowed down instead: count the values per bin of the interval that holds the
rank, go on with that one bin, and stop when its values are all equal or the rank lies at its
edge. A pass is one column-pruned scan with a partial aggregate, and only bin counts (at most
``BINS`` per interval, whatever the table size) come back to the driver. Each pass splits the
smallest from the largest value of an interval, so the search always ends; a handful of passes
is usual.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tripmart.functions.numeric import present

BINS = 1024


@dataclass(frozen=True)
class ColumnRange:
    """What one scan tells about a column. Infinities are counted apart from finite values."""

    count: int = 0
    below: int = 0  # number of -inf
    finite: int = 0
    low: float | None = None
    high: float | None = None


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values of some columns as rows ``(slot, value)``, without nulls and NaN.

    Aggregates over this form have one short piece of generated code instead of one per column.
    """
    cells = [c for i, name in enumerate(columns) for c in (F.lit(i), present(F.col(name)))]
    listed = df.select(F.stack(F.lit(len(columns)), *cells).alias("slot", "value"))
    return listed.where(F.col("value").isNotNull())


def column_statistics(
    df: DataFrame, columns: Sequence[str], *more: Column
) -> tuple[dict[str, ColumnRange], dict[str, Row]]:
    """Range of each column, and ``more`` aggregates over its ``value``, in one scan."""
    value = F.col("value")
    finite = F.when(F.abs(value) < math.inf, value)
    counted = (
        long_form(df, columns)
        .groupBy("slot")
        .agg(
            F.count("*").alias("count"),
            F.count_if(value == -math.inf).alias("below"),
            F.count(finite).alias("finite"),
            F.min(finite).alias("low"),
            F.max(finite).alias("high"),
            *more,
        )
    )
    rows = {columns[row["slot"]]: row for row in counted.collect()}
    ranges = {
        name: ColumnRange(*[rows[name][f.name] for f in fields(ColumnRange)])
        if name in rows
        else ColumnRange()
        for name in columns
    }
    return ranges, rows


@dataclass(frozen=True)
class _Interval:
    column: str
    low: float
    high: float
    before: int  # number of finite values of the column below ``low``


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnRange]:
    return column_statistics(df, columns)[0]


def _count_bins(df: DataFrame, intervals: Sequence[_Interval]) -> dict[int, list[Row]]:
    """Size and extremes of the non-empty bins of each interval, in ascending order."""
    cells = []
    for number, interval in enumerate(intervals):
        # halved where the width itself would overflow
        scale = 1.0 if math.isfinite(interval.high - interval.low) else 0.5
        width = interval.high * scale - interval.low * scale
        parameters = (interval.low, interval.high, width, scale)
        cells += [F.lit(number), present(F.col(interval.column)), *map(F.lit, parameters)]
    names = ("interval", "value", "from", "to", "width", "scale")
    listed = df.select(F.stack(F.lit(len(intervals)), *cells).alias(*names))
    value, start, scale = F.col("value"), F.col("from"), F.col("scale")
    place = F.floor((value * scale - start * scale) / F.col("width") * BINS)
    counted = (
        listed.where(value.between(start, F.col("to")))
        .groupBy("interval", F.least(place, F.lit(BINS - 1)).cast("int").alias("bin"))
        .agg(
            F.count("*").alias("size"), F.min("value").alias("low"), F.max("value").alias("high")
        )
    )
    bins = defaultdict(list)
    for row in sorted(counted.collect(), key=lambda r: (r["interval"], r["bin"])):
        bins[row["interval"]].append(row)
    return bins


def _values_at(df: DataFrame, ranges: dict[str, ColumnRange], ranks: dict[str, set[int]]):
    """Value at each 0-based rank of the ascending order of each column."""
    found: dict[tuple[str, int], float] = {}
    pending: dict[_Interval, set[int]] = defaultdict(set)
    for name, wanted in ranks.items():
        known = ranges[name]
        for rank in wanted:
            place = rank - known.below
            if place < 0:
                found[name, rank] = -math.inf
            elif place >= known.finite:
                found[name, rank] = math.inf
            elif place == 0 or known.low == known.high:
                found[name, rank] = known.low
            elif place == known.finite - 1:
                found[name, rank] = known.high
            else:
                pending[_Interval(name, known.low, known.high, 0)].add(rank)
    while pending:
        intervals = list(pending)
        bins = _count_bins(df, intervals)
        narrowed: dict[_Interval, set[int]] = defaultdict(set)
        for number, interval in enumerate(intervals):
            name, below = interval.column, ranges[interval.column].below
            start = interval.before
            for part in bins[number]:
                end = start + part["size"]
                for rank in pending[interval]:
                    place = rank - below
                    if not start <= place < end:
                        continue
                    if place == start or part["low"] == part["high"]:
                        found[name, rank] = part["low"]
                    elif place == end - 1:
                        found[name, rank] = part["high"]
                    else:
                        narrower = _Interval(name, part["low"], part["high"], start)
                        narrowed[narrower].add(rank)
                start = end
        pending = narrowed
    return found


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    ranges: dict[str, ColumnRange] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between ranks; nulls and NaN are left out.

    The table is scanned once per pass, so pass a stored table rather than a long plan.
    """
    ranges = ranges or column_ranges(df, columns)
    places = {
        name: [p * (ranges[name].count - 1) for p in probabilities]
        for name in columns
        if ranges[name].count
    }
    ranks = {
        name: {r for place in wanted for r in (math.floor(place), math.ceil(place))}
        for name, wanted in places.items()
    }
    found = _values_at(df, ranges, ranks)

    def interpolated(name: str, place: float) -> float:
        lower, upper = found[name, math.floor(place)], found[name, math.ceil(place)]
        if lower == upper:
            return lower
        share = place - math.floor(place)
        return lower * (1.0 - share) + upper * share

    return {
        name: [interpolated(name, place) for place in places[name]]
        if name in places
        else [None] * len(probabilities)
        for name in columns
    }
