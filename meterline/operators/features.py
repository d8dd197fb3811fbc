"""Derived trip columns of the silver layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import time_period, weekend_label
from meterline.functions.numeric import round_half_up

# Ratio columns: guard that must be positive (else 0), and the unrounded value.
RATIOS = {
    "avg_speed_mph": ("trip_duration_minutes", "try_divide(trip_distance, trip_duration_minutes / 60)"),
    "tip_percentage": ("fare_amount", "try_divide(tip_amount, fare_amount) * 100"),
    "fare_per_mile": ("trip_distance", "try_divide(fare_amount, trip_distance)"),
}
CALENDAR = {
    "pickup_hour": "hour(tpep_pickup_datetime)",
    "pickup_dayofweek": "dayofweek(tpep_pickup_datetime)",
    "pickup_day": "dayofmonth(tpep_pickup_datetime)",
    "pickup_month": "month(tpep_pickup_datetime)",
    "pickup_year": "year(tpep_pickup_datetime)",
    "trip_duration_minutes": (
        "(unix_timestamp(tpep_dropoff_datetime) - unix_timestamp(tpep_pickup_datetime)) / 60"
    ),
}


def trip_features(cleaned: DataFrame) -> DataFrame:
    """Durations, calendar parts, ratios and labels.

    Three projections, each reusing the columns of the one before.  Folded into
    one, the generated method would exceed the size the JVM compiles, and every
    row would be interpreted.  Ratios are taken before the amounts are rounded.
    """
    timed = cleaned.withColumns({name: F.expr(sql) for name, sql in CALENDAR.items()})
    raw = {f"_{name}": F.expr(f"IF({guard} > 0, {value}, 0D)") for name, (guard, value) in RATIOS.items()}
    labels = {
        "time_period": time_period("pickup_hour"),
        "day_type": weekend_label("pickup_dayofweek"),
    }
    rounded = {name: round_half_up(f"_{name}", 2) for name in RATIOS}
    rounded |= {name: round_half_up(name, 2) for name in ("fare_amount", "total_amount")}
    return timed.withColumns(raw | labels).withColumns(rounded).drop(*raw)
