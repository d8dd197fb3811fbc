"""Typing and row filters of the silver layer.

Rules are named SQL conditions, so a caller can add or replace them as text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.numeric import percent

# What each named column becomes.
CONVERSIONS = {
    "tpep_pickup_datetime": "try_to_timestamp(tpep_pickup_datetime)",
    "tpep_dropoff_datetime": "try_to_timestamp(tpep_dropoff_datetime)",
    "pickup_date": "to_date(try_to_timestamp(tpep_pickup_datetime))",
    **{
        name: f"try_cast({name} AS DOUBLE)"
        for name in ("fare_amount", "total_amount", "tip_amount", "trip_distance")
    },
    **{name: f"try_cast({name} AS INT)" for name in ("passenger_count", "PULocationID", "DOLocationID")},
}

# The conditions a trip must meet.
TRIP_RULES = {
    "fare_positive": "fare_amount > 0",
    "total_positive": "total_amount > 0",
    "distance_positive": "trip_distance > 0",
    "distance_below_100": "trip_distance < 100",
    "passengers_1_to_6": "passenger_count BETWEEN 1 AND 6",
    "pickup_before_dropoff": "tpep_pickup_datetime < tpep_dropoff_datetime",
    "pickup_zone_known": "PULocationID IS NOT NULL",
    "dropoff_zone_known": "DOLocationID IS NOT NULL",
}


def typed_trips(bronze: DataFrame) -> DataFrame:
    """Bring the named columns to their types; everything else passes through.

    Values that do not convert become null (and are then removed by the filters)
    instead of failing the job.  Doubles are truncated towards zero as integers.
    """
    return bronze.withColumns({name: F.expr(sql) for name, sql in CONVERSIONS.items()})


def _all_of(rules: Mapping[str, str]) -> str:
    return " AND ".join(f"({rule})" for rule in rules.values())


def clean_trips(typed: DataFrame, rules: Mapping[str, str] = TRIP_RULES) -> DataFrame:
    """Rows meeting every rule, as one conjunction so that it can be pushed down whole."""
    return typed.filter(_all_of(rules))


def rejection_mask(rules: Mapping[str, str] = TRIP_RULES) -> Column:
    """One bit per rule that a row does not meet, the first rule lowest; 0 for rows that pass."""
    bits = [f"IF(coalesce({rule}, false), 0, {1 << i})" for i, rule in enumerate(rules.values())]
    return F.expr(" + ".join(bits) or "0")


def audit_of(masks: DataFrame, rules: Mapping[str, str] = TRIP_RULES) -> DataFrame:
    """:func:`filter_audit` from rows counted by mask: (rejected, n)."""
    total = "coalesce(sum({}), 0)"
    counts = masks.agg(
        F.expr(f"{total.format('n')} AS rows_before"),
        F.expr(f"{total.format('IF(rejected = 0, n, 0)')} AS rows_after"),
        *[
            F.expr(f"{total.format(f'IF(rejected & {1 << i} != 0, n, 0)')} AS rejected_{name}")
            for i, name in enumerate(rules)
        ],
    )
    return _with_removed(counts)


def filter_audit(typed: DataFrame, rules: Mapping[str, str] = TRIP_RULES) -> DataFrame:
    """Rows before, after and removed, plus the rows each rule rejects, in one pass.

    A rule that evaluates to null rejects the row; a row may count under several rules.
    """
    counts = typed.agg(
        F.expr("count(*) AS rows_before"),
        F.expr(f"count_if({_all_of(rules)}) AS rows_after"),
        *[
            F.expr(f"count_if(NOT coalesce({rule}, false)) AS rejected_{name}")
            for name, rule in rules.items()
        ],
    )
    return _with_removed(counts)


def _with_removed(counts: DataFrame) -> DataFrame:
    removed = "rows_before - rows_after"
    return counts.withColumns(
        {
            "rows_removed": F.expr(removed),
            "removed_pct": F.coalesce(percent(removed, "rows_before"), F.lit(0.0)),
        }
    )
