"""Numeric functions that are safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def positive_ratio(value: Column, divisor: Column) -> Column:
    """``value / divisor`` where the divisor is above zero, else null."""
    return F.when(divisor > 0, value / divisor)


def present(value: Column) -> Column:
    """The value as a double, with NaN turned into null."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def _spread(value: Column) -> Column:
    """The lowest 16 bits of a number, a zero bit after each."""
    spread = F.least(F.greatest(F.coalesce(value.cast("bigint"), F.lit(0)), F.lit(0)), F.lit(0xFFFF))
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        spread = spread.bitwiseOR(F.shiftleft(spread, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return spread


def interleaved(a: Column, b: Column) -> Column:
    """The bits of two numbers in turn: rows near in both are near in this one number.

    Numbers count from 0 to 65,535; others are taken for the nearest of these, null for 0.
    """
    return F.shiftleft(_spread(a), 1).bitwiseOR(_spread(b))
