"""Seasonal forecast of daily trips, its parameters and error bounds taken from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.smoothing import SEASON, WARM_UP, continued, smoothed

# Weights that are tried for the level, the trend and the season.
LEVELS, TRENDS, SEASONS = (0.05, 0.1, 0.2, 0.3, 0.5), (0.0, 0.005, 0.02), (0.02, 0.05, 0.1, 0.2)
HELD_OUT, FORECAST_DAYS = 28, 30
# Standard errors on either side of a forecast.
BOUND = 1.96


def daily_series(daily: DataFrame, value: str = "total_trips") -> DataFrame:
    """One row: the values of all days from the first to the last, null where there is none.

    The calendar bounds the array: 365 numbers a year.
    """
    days = daily.filter("pickup_date IS NOT NULL").select(
        F.unix_date("pickup_date").cast("long").alias("day"), F.col(value).cast("double").alias("value")
    )
    span = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).filter("first IS NOT NULL")
    every = span.withColumn("day", F.explode(F.sequence("first", "last"))).join(days, "day", "left")
    listed = every.groupBy("first", "last").agg(F.sort_array(F.collect_list(F.struct("day", "value"))).alias("_days"))
    return listed.select("first", "last", F.transform("_days", lambda x: x["value"]).alias("series"))


def _mean(values: Column) -> Column:
    """Mean of the values that are there, added up in order; 0 when there are none."""
    known = F.filter(values, lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda sum_, x: sum_ + x)
    return F.when(F.size(known) > 0, total / F.size(known)).otherwise(F.lit(0.0))


def _start(series: Column, first: Column) -> tuple[Column, Column]:
    """Level and season of the first weeks: their mean, and how each weekday differs from it."""
    early = F.slice(series, 1, WARM_UP)
    level = _mean(early)

    def weekday(place: Column) -> Column:
        # the value at position i is that of day first + i
        mine = F.filter(early, lambda x, i: F.pmod(first + i, F.lit(SEASON)) == place)
        return F.when(F.size(F.filter(mine, lambda x: x.isNotNull())) > 0, _mean(mine) - level).otherwise(F.lit(0.0))

    return level, F.transform(F.sequence(F.lit(0), F.lit(SEASON - 1)), weekday)


def fitted_weights(series: DataFrame, held_out: int = HELD_OUT) -> DataFrame:
    """The series with the weights that fit its days before the last ``held_out`` best.

    Every combination of weights is a row and folds the days by itself, so they are tried in
    parallel.  ``rmse`` are the errors of its forecast of the held-out days.
    """
    trained = F.greatest(F.size("series") - held_out, F.least(F.size("series"), F.lit(1)))
    level, season = _start(F.col("train"), F.col("first"))
    prepared = series.withColumns({"train": F.slice("series", F.lit(1), trained), "test": F.slice("series", trained + 1, F.lit(held_out))})
    prepared = prepared.withColumns({"level0": level, "season0": season})
    grid = F.array(*[F.array(F.lit(a), F.lit(b), F.lit(c)) for a in LEVELS for b in TRENDS for c in SEASONS])
    tried = prepared.withColumn("w", F.explode(grid)).repartition("w")
    weights = (F.col("w")[0], F.col("w")[1], F.col("w")[2])
    state = smoothed(F.col("train"), F.col("first"), F.col("level0"), F.col("season0"), weights)
    tried = tried.withColumn("state", state)

    def square(x: Column, i: Column) -> Column:
        error = x - continued(F.col("state"), i + 1)
        return error * error

    squares = F.transform("test", square)
    best = tried.agg(F.min_by(F.struct("first", "last", "series", "test", "state", "w"), F.struct("state.errors", "w")).alias("_best"))
    best = best.select("_best.*").filter("first IS NOT NULL")
    return best.withColumn("rmse", F.sqrt(_mean(squares))).select("first", "last", "series", "w", "rmse")


def seasonal_forecast(daily: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    """(forecast_date, days_ahead, forecast_trips, lower_trips, upper_trips) beyond the last day.

    Weights are fitted before the last four weeks, the bounds come from the errors on these, and
    the forecast from all days.  Days without trips in between are left out of the fit.
    """
    fitted = fitted_weights(daily_series(daily))
    level, season = _start(F.col("series"), F.col("first"))
    fitted = fitted.withColumns({"level0": level, "season0": season})
    weights = (F.col("w")[0], F.col("w")[1], F.col("w")[2])
    fitted = fitted.withColumn("state", smoothed(F.col("series"), F.col("first"), F.col("level0"), F.col("season0"), weights))
    ahead = fitted.select("last", "state", "rmse", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("days_ahead"))
    value = continued(F.col("state"), F.col("days_ahead"))
    return ahead.select(
        F.date_from_unix_date((F.col("last") + F.col("days_ahead")).cast("int")).alias("forecast_date"),
        "days_ahead",
        F.round(value, 2).alias("forecast_trips"),
        F.round(value - BOUND * F.col("rmse"), 2).alias("lower_trips"),
        F.round(value + BOUND * F.col("rmse"), 2).alias("upper_trips"),
    )
