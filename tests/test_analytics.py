import datetime as dt

import pytest

from meterline.operators import kpis, marts, rollups, routes
from meterline.operators.cleaning import clean_trips, typed_trips
from meterline.operators.enrichment import checked_zones, silver_trips
from meterline.operators.features import trip_features

DAILY = (
    "pickup_date date, total_trips long, total_revenue double, avg_fare double, avg_distance double, "
    "avg_duration double"
)
ROUTES = (
    "PU_Borough string, PU_Zone string, DO_Borough string, DO_Zone string, total_trips long, "
    "avg_fare double, avg_distance double, _layer string"
)


@pytest.fixture(scope="module")
def daily(spark):
    def build(days, start=dt.date(2023, 1, 1), skip=()):
        rows = [
            (start + dt.timedelta(days=n), 10 + n, 100.0 + n, 5.0, 2.0, 9.0)
            for n in range(days)
            if n not in skip
        ]
        return spark.createDataFrame(rows, DAILY)

    return build


@pytest.fixture(scope="module")
def silver(trips, zones):
    start = dt.datetime(2023, 3, 15, 10)

    def trip(minutes, **more):
        return {
            "tpep_pickup_datetime": start,
            "tpep_dropoff_datetime": start + dt.timedelta(minutes=minutes),
            **more,
        }

    df = trips(
        trip(10), trip(20, fare_amount=30.0, trip_distance=5.5), trip(30, PULocationID=77), trip(40, DOLocationID=3)
    )
    return silver_trips(trip_features(clean_trips(typed_trips(df))), checked_zones(zones))


def test_daily_rollup(silver):
    row = rollups.daily_metrics(silver).first()
    assert (row.total_trips, row.total_fare, row.total_revenue, row.avg_fare) == (4, 90.0, 100.0, 22.5)
    assert (row.avg_distance, row.avg_duration, row.total_passengers, row._layer) == (8.875, 25.0, 4, "gold")


def test_unknown_zones_leave_borough_and_route_tables(silver):
    assert rollups.daily_metrics(silver).agg({"total_trips": "sum"}).first()[0] == 4
    assert rollups.borough_metrics(silver).agg({"total_trips": "sum"}).first()[0] == 3
    found = {(r.PU_Zone, r.DO_Zone): r.total_trips for r in rollups.route_metrics(silver).collect()}
    assert found == {("Alpha", "Beta"): 2, ("Alpha", "Gamma"): 1}


@pytest.mark.parametrize("build", [rollups.daily_metrics, rollups.hourly_metrics, rollups.borough_metrics])
def test_merged_sums_give_the_same_table(silver, build):
    direct, merged = (df.drop("_aggregation_timestamp") for df in (build(silver), build(rollups.trip_sums(silver), True)))
    assert direct.schema.simpleString() == merged.schema.simpleString()
    assert direct.exceptAll(merged).count() == 0 and merged.exceptAll(direct).count() == 0


def test_sums_agree_between_rollups(silver):
    totals = {
        build(silver).agg({"total_trips": "sum"}).first()[0]
        for build in (rollups.daily_metrics, rollups.hourly_metrics)
    }
    assert totals == {silver.count()}


def test_growth(spark, daily):
    one = kpis.monthly_kpis(daily(5)).collect()
    assert [(r.prev_month_trips, r.mom_growth_pct) for r in one] == [(None, 0.0)]
    rows = [(dt.date(2023, m, 1), trips, 1.0, 1.0, 1.0, 1.0) for m, trips in ((1, 0), (2, 8), (3, 6))]
    months = kpis.monthly_kpis(spark.createDataFrame(rows, DAILY)).orderBy("year_month").collect()
    assert [r.mom_growth_pct for r in months] == [0.0, None, -25.0]
    alerts = marts.growth_alerts(kpis.monthly_kpis(spark.createDataFrame(rows, DAILY)))
    got = {r.year_month: (r.direction, r.alert) for r in alerts.collect()}
    assert got == {"2023-01": ("flat", 0), "2023-02": ("flat", 0), "2023-03": ("down", 1)}


def test_moving_means_count_rows_not_days(daily):
    rows = kpis.daily_trends(daily(40, skip={20})).orderBy("pickup_date").collect()
    trips = [r.total_trips for r in rows]
    for n, row in enumerate(rows):
        frame = trips[max(0, n - 6) : n + 1]
        mean = sum(frame) / len(frame)
        assert row.trips_ma7 == int(mean + 0.5)
        assert min(frame) <= row.trips_ma7 <= max(frame)
    assert rows[2].revenue_ma30 == 101.0 and len(rows) == 39


def test_ranking_overlaps_when_days_are_few(daily):
    rows = kpis.performance_ranking(daily(7)).collect()
    assert len(rows) == 14 and len({r.pickup_date for r in rows}) == 7
    rows = kpis.performance_ranking(daily(30)).collect()
    assert len(rows) == 20 and len({r.pickup_date for r in rows}) == 20


def test_global_kpis(daily):
    row = kpis.global_kpis(daily(3)).first()
    assert (row.total_trips_ytd, row.total_revenue_ytd, row.days_in_operation, row.avg_trips_per_day) == (
        33, 303.0, 3, 11.0,
    )
    empty = kpis.global_kpis(daily(3).limit(0)).first()
    assert (empty.total_trips_ytd, empty.avg_trips_per_day, empty.days_in_operation) == (None, None, 0)


@pytest.fixture(scope="module")
def many_routes(spark):
    rows = [("A", f"z{n:03}", "B", "end", 7, 10.0, float(n % 3), "gold") for n in range(150)]
    return spark.createDataFrame(rows, ROUTES).repartition(5)


def test_ties_are_cut_by_key(many_routes):
    rows = routes.busiest_routes(many_routes).orderBy("rank_by_volume").collect()
    assert [r.PU_Zone for r in rows] == [f"z{n:03}" for n in range(100)]
    assert [r.rank_by_volume for r in rows] == list(range(1, 101))
    assert {(r.total_revenue, r._layer) for r in rows} == {(70.0, "analytics")}


def test_routes_without_distance_are_not_divided(many_routes):
    rows = routes.most_efficient_routes(many_routes).collect()
    assert len(rows) == 100 and {r.avg_distance for r in rows} == {1.0, 2.0}
    assert sorted({r.revenue_per_mile for r in rows}) == [5.0, 10.0]


def test_unknown_borough_counts_as_inter(spark):
    rows = [("A", "x", "A", "y", 3, 1.0, 1.0, ""), (None, "x", "A", "y", 2, 1.0, 1.0, ""), ("A", "x", "B", "y", 5, 1.0, 1.0, "")]
    flow = routes.borough_flow(spark.createDataFrame(rows, ROUTES))
    assert {r.flow_type: r.total_trips for r in flow.collect()} == {"Intra-Borough": 3, "Inter-Borough": 7}
    shares = {r.flow_type: r.share_pct for r in marts.flow_share(flow).collect()}
    assert shares == {"Intra-Borough": 30.0, "Inter-Borough": 70.0}


def test_equal_revenue_shares_a_rank(spark):
    rows = [(dt.date(2023, 1, 1), b, 1, r, 1.0, 1.0) for b, r in (("A", 5.0), ("B", 5.0), ("C", 1.0))]
    df = spark.createDataFrame(
        rows, "pickup_date date, PU_Borough string, total_trips long, total_revenue double, avg_fare double, avg_distance double"
    )
    assert {r.PU_Borough: r.revenue_rank for r in kpis.borough_summary(df).collect()} == {"A": 1, "B": 1, "C": 2}


def test_forecast_continues_a_line(daily):
    rows = marts.trip_forecast(daily(10)).orderBy("days_ahead").collect()
    assert len(rows) == 30
    assert (rows[0].forecast_date, rows[0].forecast_trips) == (dt.date(2023, 1, 11), 20.0)
    assert rows[29].forecast_trips == 49.0
    flat = marts.trip_forecast(daily(1)).orderBy("days_ahead").collect()
    assert {r.forecast_trips for r in flat} == {10.0}
    assert marts.trip_forecast(daily(1).limit(0)).count() == 0


def test_trend_matches_builtin_regression(daily):
    from pyspark.sql import functions as F

    monthly = kpis.monthly_kpis(daily(300))
    trend = marts.revenue_trend(monthly)
    want = trend.agg(F.regr_slope("monthly_revenue", "month_index")).first()[0]
    got = {r.trend_slope for r in trend.collect()}
    assert len(got) == 1 and got.pop() == pytest.approx(want, abs=1e-3)


def test_slicers(silver):
    day = dt.date(2023, 3, 15)
    assert marts.sliced(silver).count() == 4
    assert marts.sliced(silver, dates=(day, day), hours=(10, 10), weekdays=("Wednesday",)).count() == 4
    assert marts.sliced(silver, weekdays=("Sunday",)).count() == 0
    assert marts.sliced(silver, boroughs=("NORTH",)).count() == 3
