import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from meterline.operators.cleaning import TRIP_RULES, clean_trips, filter_audit, typed_trips
from meterline.operators.enrichment import DuplicateZoneError, checked_zones, silver_trips
from meterline.operators.features import trip_features

DAY = dt.datetime(2023, 3, 15)


def at(hour, minute=0, second=0, micro=0, day=DAY):
    start = day.replace(hour=hour, minute=minute, second=second, microsecond=micro)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=15)}


def kept(df):
    return clean_trips(typed_trips(df))


def features(df):
    return trip_features(kept(df))


def test_time_periods(trips):
    starts = [(5, 59), (6, 0), (11, 59), (12, 0), (17, 59), (18, 0), (21, 59), (22, 0)]
    rows = features(trips(*[at(*s) for s in starts])).orderBy("tpep_pickup_datetime").collect()
    assert [r.time_period for r in rows] == (
        ["Night"] + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2 + ["Night"]
    )


def test_day_types(trips):
    days = [DAY + dt.timedelta(days=n) for n in (3, 4, 5)]  # Saturday, Sunday, Monday
    rows = features(trips(*[at(8, day=d) for d in days])).orderBy("pickup_date").collect()
    assert [(r.day_type, r.pickup_dayofweek) for r in rows] == [("Weekend", 7), ("Weekend", 1), ("Weekday", 2)]


@pytest.mark.parametrize(
    "column, values, survivors",
    [
        ("trip_distance", [0.0, 0.01, 99.99, 100.0, math.nan, None], [0.01, 99.99]),
        ("passenger_count", [0.9, 1.5, 6.7, 7.0, None, math.nan], [1, 6]),
        ("fare_amount", [-1.0, 0.0, 0.004, 5.0, None], [0.004, 5.0]),
        ("total_amount", [0.0, 0.01, None], [0.01]),
        ("PULocationID", [None, 4], [4]),
        ("DOLocationID", [None, 4], [4]),
    ],
)
def test_filters(trips, column, values, survivors):
    rows = kept(trips(*[{column: v} for v in values])).select(column).collect()
    assert sorted(r[0] for r in rows) == survivors


def test_pickup_must_precede_dropoff(trips):
    start = at(9)["tpep_pickup_datetime"]
    ends = [start, start - dt.timedelta(seconds=1), start + dt.timedelta(microseconds=500_000), None]
    df = trips(*[{"tpep_pickup_datetime": start, "tpep_dropoff_datetime": e} for e in ends])
    rows = features(df).collect()
    assert len(rows) == 1
    assert (rows[0].trip_duration_minutes, rows[0].avg_speed_mph) == (0.0, 0.0)


def test_ratios_use_unrounded_amounts(trips):
    row = features(trips({"fare_amount": 0.004, "tip_amount": 0.001, "total_amount": 1.005})).first()
    assert (row.fare_amount, row.tip_percentage, row.total_amount) == (0.0, 25.0, 1.01)
    row = features(trips({"tip_amount": None})).first()
    assert (row.tip_percentage, row.fare_per_mile, row.avg_speed_mph) == (None, 2.0, 20.0)


def test_calendar_columns(trips):
    row = features(trips(at(23, 5))).first()
    got = (row.pickup_date, row.pickup_hour, row.pickup_day, row.pickup_month, row.pickup_year)
    assert got == (DAY.date(), 23, 15, 3, 2023)


def test_unconvertible_values_become_null(spark):
    df = spark.createDataFrame(
        [("2023-03-15 10:00:00", "x", "many", "1.5", "a", "2", "3", "1", "2")],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count string, trip_distance string,"
        "fare_amount string, total_amount string, tip_amount string, PULocationID string, DOLocationID string",
    )
    row = typed_trips(df).first()
    assert row.pickup_date == DAY.date() and row.trip_distance == 1.5 and row.PULocationID == 1
    assert (row.tpep_dropoff_datetime, row.passenger_count, row.fare_amount) == (None, None, None)


def test_zone_free_timestamps_are_accepted(spark, trips):
    ntz = trips().withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )
    row = features(ntz).first()
    assert (row.trip_duration_minutes, row.pickup_hour) == (30.0, 10)


def test_audit_counts_every_rule(trips):
    df = trips({}, {"fare_amount": 0.0, "trip_distance": 0.0}, {"passenger_count": None}, {"DOLocationID": None})
    row = filter_audit(typed_trips(df)).first().asDict()
    assert (row["rows_before"], row["rows_after"], row["rows_removed"], row["removed_pct"]) == (4, 1, 3, 75.0)
    rejected = {name: row[f"rejected_{name}"] for name in TRIP_RULES if row[f"rejected_{name}"]}
    assert rejected == {
        "fare_positive": 1, "distance_positive": 1, "passengers_1_to_6": 1, "dropoff_zone_known": 1,
    }


def test_audit_of_nothing(trips):
    row = filter_audit(typed_trips(trips().limit(0))).first()
    assert (row.rows_before, row.rows_removed, row.removed_pct) == (0, 0, 0.0)


def test_zone_join_keeps_every_trip(trips, zones):
    df = features(trips({}, {"DOLocationID": 99}, {"PULocationID": 3}))
    rows = silver_trips(df, checked_zones(zones)).orderBy("PULocationID", "DOLocationID").collect()
    assert [(r.PU_Borough, r.PU_Zone, r.DO_Borough, r.DO_Zone) for r in rows] == [
        ("NORTH", "Alpha", "NORTH", "Beta"),
        ("NORTH", "Alpha", None, None),
        ("SOUTH", "Gamma", "NORTH", "Beta"),
    ]
    assert {r._layer for r in rows} == {"silver"}


def test_duplicate_zone_ids_are_refused(zones):
    with pytest.raises(DuplicateZoneError):
        checked_zones(zones.unionByName(zones.limit(1)))


def test_rules_can_be_replaced(trips):
    df = typed_trips(trips({"trip_distance": 500.0}, {"fare_amount": -1.0}))
    assert clean_trips(df, {"fare": "fare_amount > 0"}).count() == 1
