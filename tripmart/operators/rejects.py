"""Rows that cleaning refuses, with the rule they break, kept so that they can be tried again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import CleaningRules, use_compiled_code, use_utc
from tripmart.functions.columns import free_name
from tripmart.operators.cleaning import (
    clean,
    lacks_required,
    rename_present,
    with_trip_measures,
    with_types,
)
from tripmart.schema import REQUIRED, TRIP_TYPES

RULE, COPIES = "rule", "nb_copies"


def _unreadable(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """Whether a value is there that the declared type cannot hold."""
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def broken_rules(rows: DataFrame, rules: CleaningRules, rule_col: str) -> DataFrame:
    """Raw rows with the first rule each breaks, in the order of the cleaning; null if it breaks none.

    A required value that is there but unreadable breaks ``unreadable_<column>``, not the rule that its
    null would break later.
    """
    raw = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    whole, lacking, unread = (free_name(n, rows.columns) for n in ("_raw", "_lacking", "_unread"))
    required = [n for n in REQUIRED if n in rows.columns]
    first_unread = F.coalesce(
        *[F.when(_unreadable(rows, n, TRIP_TYPES[n]), F.lit(f"unreadable_{n}")) for n in required],
        F.lit(None).cast("string"),
    )
    judged = (
        rows.withColumns({whole: raw, lacking: lacks_required(rows, REQUIRED), unread: first_unread})
        .transform(with_types)
        .transform(with_trip_measures)
    )
    ordered = F.col("dropoff_datetime") > F.col("pickup_datetime")
    later = {"not_in_time_order": ordered} | rules.checks()
    first_broken = F.coalesce(
        F.when(F.col(lacking), F.lit("missing_value")),
        F.col(unread),
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in later.items()],
    )
    return judged.select(F.col(whole).alias("raw"), first_broken.alias(rule_col)).select("raw.*", rule_col)


def rejected_trips(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Each raw row that cleaning refuses, once, as it was read, with its ``rule`` and ``nb_copies``.

    These are the last two columns; an underscore is put before a name that the rows have already.
    Rows read = trips kept + copies + rejected rows. The grouping combines before its shuffle, as
    the removal of copies does. All rules are judged in the scan, which makes a long method.
    """
    use_utc(use_compiled_code(raw.sparkSession))
    rows = rename_present(raw)
    names = [f"`{c}`" for c in rows.columns]
    copies = free_name(COPIES, rows.columns)
    rule = free_name(RULE, [*rows.columns, copies])
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias(copies))
    judged = broken_rules(counted, rules, rule).where(F.col(rule).isNotNull())
    return judged.select(*names, rule, copies)


def tried_again(rejected: DataFrame, rules: CleaningRules) -> DataFrame:
    """The clean trips that other rules make of rejected rows."""
    return clean(rejected.drop(*rejected.columns[-2:]), rules)


def unreadable_values(raw: DataFrame, most: int = 1000) -> DataFrame:
    """column, value, nb_rows: values that the declared types cannot hold, by column.

    Required ones make a row be rejected, the others are null in the clean trip. Long texts are
    shown by their first ``most`` characters; values that agree in these are counted together.
    """
    use_utc(raw.sparkSession)
    rows = rename_present(raw)
    entries = [
        F.when(
            _unreadable(rows, name, kind),
            F.struct(F.lit(name).alias("column"), F.substring(F.col(name).cast("string"), 1, most).alias("value")),
        )
        for name, kind in TRIP_TYPES.items()
        if name in rows.columns
    ]
    found = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")) if entries else None
    if found is None:
        return rows.sparkSession.createDataFrame([], "column string, value string, nb_rows bigint")
    return found.groupBy("e.column", "e.value").agg(F.count(F.lit(1)).alias("nb_rows"))
