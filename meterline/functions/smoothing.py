"""Exponential smoothing with a weekly season, as an ordered fold over an array of days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The season, and the days at the start that the first level and season are averages of.
SEASON = 7
WARM_UP = 4 * SEASON


def smoothed(series: Column, first: Column, level: Column, season: Column, weights: tuple[Column, Column, Column]) -> Column:
    """Struct (level, trend, season, errors) after all values of ``series``.

    ``series`` are the values of consecutive days, null where a day has none; day ``first`` is
    that of the first one, and day ``d`` has the season ``d % 7``.  Each day's value is compared
    with level + trend + season; ``weights`` say how far the error moves the level, the trend and
    the season.  Days without a value move the level by the trend.  ``errors`` is the sum of the
    squared errors.
    """
    to_level, to_trend, to_season = weights
    start = F.struct(
        level.cast("double").alias("level"),
        F.lit(0.0).alias("trend"),
        season.alias("season"),
        F.lit(0.0).alias("errors"),
        first.cast("long").alias("day"),
    )

    def step(state: Column, value: Column) -> Column:
        place = F.pmod(state["day"], F.lit(SEASON)).cast("int")
        known = state["level"] + state["trend"]
        error = F.coalesce(value - (known + state["season"][place]), F.lit(0.0))
        moved = F.transform(state["season"], lambda x, i: F.when(i == place, x + to_season * error).otherwise(x))
        return F.struct(
            (known + to_level * error).alias("level"),
            (state["trend"] + to_trend * error).alias("trend"),
            moved.alias("season"),
            (state["errors"] + error * error).alias("errors"),
            (state["day"] + 1).alias("day"),
        )

    return F.aggregate(series, start, step)


def continued(state: Column, ahead: Column) -> Column:
    """The value ``ahead`` days after the last one of a smoothed series (1: the next day)."""
    place = F.pmod(state["day"] + ahead - 1, F.lit(SEASON)).cast("int")
    return state["level"] + state["trend"] * ahead + state["season"][place]
