"""Display labels of coded columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: day number (1 is Sunday) -> label
WEEKDAY_LABELS = {1: "Dim", 2: "Lun", 3: "Mar", 4: "Mer", 5: "Jeu", 6: "Ven", 7: "Sam"}
# fixed values: order in which the labels are shown
WEEKDAY_ORDER = ("Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim")
# fixed values: labels of the weekend flag
WEEKEND_LABEL, WORKDAY_LABEL = "Week-end", "Semaine"


def mapped(code: Column, labels: dict) -> Column:
    """Label of a code; null for a code without one."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), code)


def weekday_label(day_of_week: Column) -> Column:
    return mapped(day_of_week, WEEKDAY_LABELS)


def weekday_position(day_of_week: Column) -> Column:
    """Place of a day in display order, Monday first; null for a code that is no day."""
    places = {day: WEEKDAY_ORDER.index(label) for day, label in WEEKDAY_LABELS.items()}
    return mapped(day_of_week, places)


def weekend_label(flag: Column) -> Column:
    return F.when(flag, WEEKEND_LABEL).when(~flag, WORKDAY_LABEL)


def category(code: Column) -> Column:
    """A number as the text of a category axis."""
    return code.cast("string")
