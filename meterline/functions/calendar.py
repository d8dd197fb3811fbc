"""Date and hour classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, and the hour at which each period starts (Night before the first).
MORNING, AFTERNOON, EVENING, NIGHT = "Morning", "Afternoon", "Evening", "Night"
TIME_PERIODS = (MORNING, AFTERNOON, EVENING, NIGHT)
PERIOD_STARTS = ((22, NIGHT), (18, EVENING), (12, AFTERNOON), (6, MORNING))
WEEKEND, WEEKDAY = "Weekend", "Weekday"
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def time_period(hour: str) -> Column:
    """Label of the part of the day; the latest start not after the hour wins."""
    branches = " ".join(f"WHEN {hour} >= {start} THEN '{label}'" for start, label in PERIOD_STARTS)
    return F.expr(f"CASE {branches} ELSE '{NIGHT}' END")


def weekend_label(day_of_week: str) -> Column:
    """Weekend for day 1 (Sunday) and day 7 (Saturday)."""
    return F.expr(f"IF({day_of_week} IN (1, 7), '{WEEKEND}', '{WEEKDAY}')")


def weekday_name(day_of_week: str) -> Column:
    names = ", ".join(f"'{name}'" for name in WEEKDAY_NAMES)
    return F.expr(f"element_at(array({names}), {day_of_week})")


def year_month(date: str) -> Column:
    return F.expr(f"date_format({date}, 'yyyy-MM')")
