"""Time functions. They assume the UTC session that ``use_utc`` sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATURDAY, SUNDAY = 7, 1  # day numbers as ``dayofweek`` gives them


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down; also for timestamps without a zone."""
    return F.unix_seconds(ts.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes, from whole seconds on both sides."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def is_weekend_day(day_of_week: Column) -> Column:
    return day_of_week.isin(SUNDAY, SATURDAY)


def period_label(year: Column, month: Column) -> Column:
    """``2024-03`` from a year and a month number; null where either is unknown."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def iso_timestamp(text: Column) -> Column:
    """Timestamp of an ISO 8601 text; null when it is not one."""
    return F.try_to_timestamp(text)


def file_stamp(file_name: Column) -> Column:
    """Time of retrieval from a ``..._20240131T235959Z.ext`` file name; null without one."""
    stamp = F.regexp_extract(file_name, r"_(\d{8}T\d{6})Z\.\w+$", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd'T'HHmmss"))


def feed_timestamp(text: Column) -> Column:
    """Timestamp of a feed date such as ``Mon, 06 Sep 2021 16:45:00 GMT``; null if malformed.

    The weekday is redundant and not part of Spark's parse patterns, so it is cut off first.
    """
    rest = F.regexp_replace(F.trim(text), r"^[A-Za-z]+,\s*", "")
    zone_name = F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss z"))
    zone_offset = F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss xx"))
    return F.coalesce(zone_name, zone_offset)
