import datetime as dt
import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from meterline.operators import enrichment, kpis, marts, quality, rollups, routes
from meterline.plans.queries import Layers, all_queries
from meterline.sources.lake import write_table

FOLDER = "/root/testdata/sf0.001"
JIT_LIMIT = 8000  # bytes of a method above which the JVM interprets it


def plan(df, mode="simple"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture()
def layers(spark):
    return Layers(spark, FOLDER)


def test_zone_joins_are_broadcast_when_small(layers):
    assert plan(layers.silver()).count("BroadcastHashJoin") >= 2 and "LeftOuter" in plan(layers.silver())


def test_zone_joins_shuffle_when_large(spark, layers):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        features = layers.features()
        joined = enrichment.attach_zones(features, enrichment.checked_zones(layers.raw_zones()))
        text = plan(joined)
        assert "SortMergeJoin" in text and "Broadcast" not in text
        wide = joined.groupBy("PU_Zone", "DO_Zone").count()
        spark.conf.unset(key)
        narrow = layers.silver().groupBy("PU_Zone", "DO_Zone").count()
        assert wide.exceptAll(narrow).count() == 0 and narrow.exceptAll(wide).count() == 0
    finally:
        spark.conf.unset(key)


def test_top_k_is_distributed(layers):
    for df in (routes.busiest_routes(layers.routes()), kpis.performance_ranking(layers.daily())):
        assert "TakeOrderedAndProject" in plan(df)


def test_filters_reach_the_line_item_scan(layers):
    text = plan(layers.daily(), "formatted")
    scan = next(part for part in text.split("\n\n") if "l_extendedprice" in part and "ReadSchema" in part)
    assert "l_returnflag" not in scan and "IsNotNull(l_quantity)" in scan


def test_rollups_combine_before_the_shuffle(layers):
    assert plan(layers.hourly()).count("HashAggregate") == 2
    assert "SortAggregate" not in plan(layers.hourly())


def test_date_slices_prune_partitions(spark, tmp_path):
    days = spark.range(30).selectExpr("date_add(DATE '2023-01-01', CAST(id AS INT)) AS pickup_date", "id")
    write_table(days, f"{tmp_path}/t", ("pickup_date",), few_per_partition=True)
    cut = marts.sliced(spark.read.parquet(f"{tmp_path}/t"), dates=(dt.date(2023, 1, 3), dt.date(2023, 1, 5)))
    assert "PartitionFilters: [isnotnull(pickup_date" in plan(cut) and cut.count() == 3


def test_generated_methods_stay_compilable(spark, layers):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (layers.features(), layers.silver(), layers.daily(), layers.hourly(), layers.routes()):
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(df, "codegen"))]
            assert sizes and max(sizes) < JIT_LIMIT
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_and_no_cross_join(layers):
    for df in (layers.trends(), rollups.borough_revenue(layers.borough()), marts.trip_forecast(layers.daily())):
        text = plan(df)
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_windows_see_one_row_per_day(layers):
    daily = layers.daily()
    assert daily.count() == daily.select(F.countDistinct("pickup_date")).first()[0] < 4_000_000


@pytest.mark.parametrize(
    "name",
    ["mart_daily_with_month", "mart_daily_hourly", "mart_routes_with_borough", "mart_sliced_hourly", "mart_seasonal_forecast"]
    + ["cube_hours", "cube_boroughs", "cube_weekdays"],
)
def test_marts_scan_no_fact_table(spark, name):
    text = plan(all_queries()[name](spark, FOLDER), "formatted")
    assert "lineitem" not in text and "orders.parquet" not in text


def test_a_slice_prunes_days(spark):
    text = plan(all_queries()["mart_sliced_hourly"](spark, FOLDER), "formatted")
    assert "PartitionFilters: [" in text and "pickup_date" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_checks_and_statistics_share_a_pass(spark, layers):
    measures = quality.measured(layers.silver())
    assert plan(measures).count("Scan parquet") == plan(quality.run_checks(layers.silver())).count("Scan parquet")
    assert quality.checks_of(measures).collect() == quality.run_checks(layers.silver()).collect()
    assert quality.statistics_of(measures).collect() == quality.trip_statistics(layers.silver()).collect()


@pytest.mark.parametrize("name", ["cube_hours", "cube_boroughs", "cube_weekdays"])
def test_slices_of_the_cube_scan_one_set(spark, name):
    text = plan(all_queries()[name](spark, FOLDER), "formatted")
    assert "trips_cleaned" not in text and "cube_set" in text.split("PartitionFilters: [")[1].split("]")[0]
