"""Gold aggregates over silver trips.

Every measure is a sum or a count, so Spark combines map-side and only one row
per group and task is shuffled, however many trips a hot group holds.

The sums are exact integers, so they can also be merged: one pass over the trips
yields the sums per day, hour and borough, and the daily, hourly and borough
tables are merged from that small table without reading the trips again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import year_month
from meterline.functions.numeric import (
    CENTS,
    MICROS,
    SECONDS_PER_MINUTE,
    exact_sum,
    total_of,
    unit_sums,
)
from meterline.layout import GOLD
from meterline.operators.stamps import tag

ROUTE_KEYS = ("PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone")
BASE_KEYS = ("pickup_date", "pickup_hour", "PU_Borough")

# Units of the summed trip columns.
UNITS = {
    "fare_amount": CENTS,
    "total_amount": CENTS,
    "trip_distance": MICROS,
    "trip_duration_minutes": SECONDS_PER_MINUTE,
    "tip_percentage": CENTS,
    "avg_speed_mph": CENTS,
}
# Measures: column, whether it is averaged, and the digits kept.
MEASURES = {
    "total_fare": ("fare_amount", False, 2),
    "total_revenue": ("total_amount", False, 2),
    "avg_fare": ("fare_amount", True, 2),
    "avg_distance": ("trip_distance", True, 3),
    "avg_duration": ("trip_duration_minutes", True, 2),
    "avg_tip_pct": ("tip_percentage", True, 2),
    "avg_speed": ("avg_speed_mph", True, 2),
}
DAILY = (
    "total_trips",
    "total_fare",
    "total_revenue",
    "avg_fare",
    "avg_distance",
    "avg_duration",
    "avg_tip_pct",
    "total_passengers",
)
HOURLY = ("total_trips", "avg_fare", "avg_distance", "avg_speed")
BOROUGH = ("total_trips", "total_revenue", "avg_fare", "avg_distance")
ROUTE = ("total_trips", "avg_fare", "avg_distance")
_KNOWN_ROUTE = "PU_Zone IS NOT NULL AND DO_Zone IS NOT NULL"


def _measure(name: str, merged: bool) -> str:
    """SQL of a measure, over trips or over already summed groups."""
    if name == "total_trips":
        return "sum(trips)" if merged else "count(*)"
    if name == "total_passengers":
        return "sum(passengers)" if merged else "sum(passenger_count)"
    column, averaged, digits = MEASURES[name]
    parts = unit_sums(column, UNITS[column])
    if merged:
        parts = {part: f"sum({column}_{part})" for part in parts}
    value = total_of(**parts, per_one=UNITS[column])
    if averaged:
        count = f"sum({column}_count)" if merged else f"count({column})"
        value = f"try_divide({value}, {count})"
    return f"round({value}, {digits})"


def grouped_measures(df: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...], merged: bool) -> DataFrame:
    """Named measures per group, over trips or over already summed groups."""
    return df.groupBy(*keys).agg(*[F.expr(f"{_measure(name, merged)} AS {name}") for name in measures])


def _grouped(df: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...], merged: bool) -> DataFrame:
    return tag(grouped_measures(df, keys, measures, merged), GOLD, "_aggregation_timestamp")


def trip_sums(
    silver: DataFrame, keys: tuple[str, ...] = BASE_KEYS, columns: tuple[str, ...] = tuple(UNITS)
) -> DataFrame:
    """Counts and exact sums per group, ready to be merged into coarser groups."""
    sums = {"trips": "count(*)", "passengers": "sum(passenger_count)"}
    for column in columns:
        sums |= {f"{column}_{part}": sql for part, sql in unit_sums(column, UNITS[column]).items()}
        sums[f"{column}_count"] = f"count({column})"
    return silver.groupBy(*keys).agg(*[F.expr(f"{sql} AS {name}") for name, sql in sums.items()])


def monthly_trip_sums(silver: DataFrame) -> DataFrame:
    """:func:`trip_sums` with the ``month`` they belong to."""
    return trip_sums(silver).withColumn("month", year_month("pickup_date"))


def monthly_route_sums(silver: DataFrame) -> DataFrame:
    """Counts and exact sums per route and ``month``; months add up to the route table."""
    dated = silver.filter(_KNOWN_ROUTE).withColumn("month", year_month("pickup_date"))
    return trip_sums(dated, ("month", *ROUTE_KEYS), ("fare_amount", "trip_distance"))


def daily_metrics(df: DataFrame, merged: bool = False) -> DataFrame:
    """Per day; like the next two, over trips or, with ``merged``, over :func:`trip_sums`."""
    return _grouped(df, ("pickup_date",), DAILY, merged)


def hourly_metrics(df: DataFrame, merged: bool = False) -> DataFrame:
    return _grouped(df, ("pickup_date", "pickup_hour"), HOURLY, merged)


def borough_metrics(df: DataFrame, merged: bool = False) -> DataFrame:
    return _grouped(df.filter("PU_Borough IS NOT NULL"), ("pickup_date", "PU_Borough"), BOROUGH, merged)


def route_metrics(df: DataFrame, merged: bool = False) -> DataFrame:
    """Per route, over trips or, with ``merged``, over :func:`monthly_route_sums`."""
    return _grouped(df.filter(_KNOWN_ROUTE), ROUTE_KEYS, ROUTE, merged)


def borough_revenue(borough: DataFrame) -> DataFrame:
    """Revenue per borough over all days."""
    return borough.groupBy("PU_Borough").agg(exact_sum("total_revenue", CENTS, 2).alias("revenue"))
