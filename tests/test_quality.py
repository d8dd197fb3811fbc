import datetime as dt
import math

from pyspark.sql import functions as F

from meterline.operators import quality, verification
from meterline.operators.features import trip_features
from meterline.operators.cleaning import typed_trips


def statuses(df):
    return {r.check_name: r.status for r in quality.run_checks(df).collect()}


def test_each_check_finds_its_violation(trips):
    start = dt.datetime(2023, 3, 15, 10)
    good = trip_features(typed_trips(trips({}, {"passenger_count": None})))
    assert set(statuses(good).values()) == {"PASSED"}
    for check, column, value in (
        ("critical_columns_not_null", "trip_distance", None),
        ("fare_positive", "fare_amount", 0.0),
        ("distance_positive", "trip_distance", 0.0),
        ("passengers_valid", "passenger_count", 7.0),
        ("speed_reasonable", "tpep_dropoff_datetime", start + dt.timedelta(minutes=1)),
        ("pickup_before_dropoff", "tpep_dropoff_datetime", start),
    ):
        found = statuses(trip_features(typed_trips(trips({}, {column: value}))))
        assert {name for name, status in found.items() if status == "FAILED"} == {check}
    wrong = good.withColumn("time_period", F.lit("Noon"))
    assert statuses(wrong)["time_period_valid"] == "FAILED"


def test_tiny_fare_fails_after_rounding(trips):
    found = statuses(trip_features(typed_trips(trips({"fare_amount": 0.004}))))
    assert found["fare_positive"] == "FAILED"


def test_no_data_fails(trips):
    empty = trip_features(typed_trips(trips().limit(0)))
    results = quality.run_checks(empty)
    assert statuses(empty)["data_exists"] == "FAILED"
    summary = quality.check_summary(results).first()
    assert (summary.checks_run, summary.checks_failed, summary.failed_checks) == (8, 1, "data_exists")
    assert summary.pass_rate == 87.5


def test_null_profile_counts_nan_only_in_floats(trips):
    df = trips({}, {"trip_distance": math.nan}, {"trip_distance": None}, {"tpep_pickup_datetime": None})
    rows = {r.column_name: r for r in quality.null_profile(df, df.columns).collect()}
    assert (rows["trip_distance"].null_count, rows["trip_distance"].null_pct) == (2, 50.0)
    assert rows["trip_distance"].status == "WARNING" and rows["fare_amount"].status == "PASSED"
    assert rows["tpep_pickup_datetime"].null_count == 1


def test_required_columns(trips):
    rows = quality.required_columns({"t": (trips({}, {"fare_amount": None}), ("fare_amount", "absent"))}).collect()
    assert {r.column_name: (r.filled_rows, r.status) for r in rows} == {
        "fare_amount": (1, "PASSED"), "absent": (0, "FAILED"),
    }


def test_boroughs_count_null(spark, zones):
    rows = quality.zone_boroughs(zones.unionByName(zones.limit(1).withColumn("Borough", F.lit(None)))).collect()
    assert {r.borough_count for r in rows} == {4} and {r.status for r in rows} == {"WARNING"}
    assert {r.status for r in quality.zone_boroughs(zones, minimum=3).collect()} == {"PASSED"}


def test_layer_values(zones):
    good, wrong = zones.withColumn("_layer", F.lit("bronze")), zones.withColumn("_layer", F.lit("gold"))
    rows = verification.layer_values({"bronze.taxi_zone_lookup": good.unionByName(wrong)}).collect()
    assert {r.layer_value: (r.record_count, r.status) for r in rows} == {
        "bronze": (3, "PASSED"), "gold": (3, "FAILED"),
    }


def test_verdicts(spark, zones):
    tagged = zones.withColumn("_layer", F.lit("bronze"))
    checks = verification.table_checks({"bronze.taxi_zone_lookup": tagged, "bronze.trips": None})
    layer = verification.layer_status(checks).first()
    assert (layer.tables, layer.warnings, layer.failed, layer.verdict) == (2, 1, 1, "ISSUES FOUND")
    assert verification.overall_status(checks).first().verdict == "FAILED"


def test_thresholds_are_parameters(zones):
    rows = verification.minimum_records({"bronze.taxi_zone_lookup": zones}, {"bronze.taxi_zone_lookup": 3})
    assert rows.first().status == "PASSED"
    assert verification.minimum_records({"bronze.taxi_zone_lookup": zones}).first().status == "WARNING"
