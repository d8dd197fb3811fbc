"""Types of united sources, the place where two tables differ, slices from the cube, seasonal forecast."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import cube, digests, forecast, marts, rollups
from meterline.sources import drift
from meterline.sources.trips import month_drift, read_months

PLAIN = [
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2),
    T.DecimalType(38, 0), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.NullType(),
]


def test_common_types_form_a_lattice():
    for a, b in itertools.product(PLAIN, PLAIN):
        both = drift.common_type(a, b)
        assert both == drift.common_type(b, a) and drift.common_type(a, a) == a
        assert drift.common_type(both, a) == both == drift.common_type(both, b), (a, b, both)


@pytest.mark.parametrize(
    "left, right, common",
    [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "smallint", "float"), ("float", "int", "double"),
        ("decimal(5,2)", "int", "decimal(12,2)"), ("decimal(38,10)", "bigint", "double"), ("decimal(4,1)", "float", "double"),
        ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "string", "string"),
        ("boolean", "int", "string"), ("array<int>", "array<int>", "array<int>"),
    ],
)
def test_common_types(spark, left, right, common):
    kinds = [T.StructType.fromDDL(f"x {kind}")[0].dataType for kind in (left, right, common)]
    assert drift.common_type(*kinds[:2]) == kinds[2]


def test_nested_types_that_differ_are_an_error():
    with pytest.raises(TypeError, match="no common type"):
        drift.common_type(T.ArrayType(T.IntegerType()), T.StringType())


def test_drift_of_months_and_parts(spark, tmp_path):
    paths = [f"{tmp_path}/yellow_tripdata_2023-0{i}.parquet" for i in (1, 2)]
    spark.sql("SELECT 1 AS n, 'x' AS text").coalesce(1).write.parquet(paths[0])
    spark.sql("SELECT 2L AS N, 7 AS text, 1.5D AS fee").coalesce(1).write.parquet(paths[1])
    spark.sql("SELECT 2.5D AS N").coalesce(1).write.mode("append").parquet(paths[1])
    rows = {(r.column_name, r.source[:24], r.source_type): (r.common_type, r.change) for r in month_drift(spark, paths).collect()}
    month = "yellow_tripdata_2023-01."
    assert rows[("n", month, "int")] == ("double", "widened") and rows[("text", month, "string")] == ("string", "same")
    assert rows[("fee", month, None)] == ("double", "absent")
    parts = {key[2]: value for key, value in rows.items() if key[0] == "n" and key[1] != month}
    assert parts == {"bigint": ("double", "widened"), "double": ("double", "respelled")}
    united = read_months(spark, paths)
    assert dict(united.dtypes)["n"] == "double" and sorted(r.text or "" for r in united.collect()) == ["", "7", "x"]


def test_a_month_that_cannot_be_read_is_an_error(spark, tmp_path):
    month = tmp_path / "yellow_tripdata_2023-01.parquet"
    spark.range(2).coalesce(1).write.parquet(str(month))
    (month / "part-x.parquet").write_text("not a table")
    with pytest.raises(Exception, match="part-x|not a Parquet|FAILED_READ"):
        read_months(spark, [str(month)])


# reconciliation -------------------------------------------------------------------


def dated(spark, rows):
    return spark.createDataFrame(rows, "pickup_date date, fare double, name string, _note string")


def day(month, number):
    return dt.date(2023, month, number)


def found(df):
    return {r.pickup_date: (r.expected_rows, r.actual_rows, r.missing, r.surplus) for r in df.collect()}


def test_one_changed_fare_names_its_day(spark):
    rows = [(day(m, d), float(d), f"{m}", "a") for m in (1, 2, 3) for d in range(1, 20)]
    other = [(*row[:3], "b") for row in rows if row[0] != day(2, 7)] + [(day(2, 7), 7.01, "2", "b")]
    columns = ["fare", "name"]
    assert found(digests.differing_days(dated(spark, rows), dated(spark, other), columns)) == {day(2, 7): (1, 1, 1, 1)}
    assert found(digests.differing_days(dated(spark, rows), dated(spark, rows[::-1]).repartition(5), columns)) == {}


def test_rows_repeated_missing_null_and_swapped(spark):
    left = [(day(1, 1), 1.0, "x", "")] * 3 + [(None, 2.0, None, "")] + [(day(1, 2), 0.0, "a", ""), (day(1, 3), None, "b", "")]
    right = [(day(1, 1), 1.0, "x", "")] * 2 + [(None, 2.5, None, "")] + [(day(1, 2), -0.0, "a", ""), (day(1, 3), 0.0, "b", ""), (day(5, 1), 1.0, "n", "")]
    got = found(digests.differing_days(dated(spark, left), dated(spark, right), ["fare", "name"]))
    assert got == {day(1, 1): (3, 2, 1, 0), None: (1, 1, 1, 1), day(1, 3): (1, 1, 1, 1), day(5, 1): (0, 1, 0, 1)}
    empty = dated(spark, [])
    assert found(digests.differing_days(empty, empty, ["fare"])) == {}
    assert found(digests.differing_days(empty, dated(spark, right[-1:]), ["fare"])) == {day(5, 1): (0, 1, 0, 1)}


def test_only_days_that_differ_are_read_row_by_row(spark, tmp_path):
    rows = spark.range(3000).selectExpr("date_add(DATE '2023-01-01', CAST(id % 300 AS INT)) AS pickup_date", "id")
    rows.write.partitionBy("pickup_date").parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    changed = stored.withColumn("id", F.when(F.col("id") == 42, -1).otherwise(F.col("id")))
    result = digests.differing_days(stored, changed, ["id"])
    assert found(result) == {day(2, 12): (10, 10, 1, 1)}
    assert "pickup_date#" in (plan := result._jdf.queryExecution().executedPlan().toString())
    assert "PartitionFilters: [" in plan and "2023-02-12" in plan


# slices ---------------------------------------------------------------------------


def test_the_smallest_set_that_answers_is_chosen():
    sizes = {cube.set_name(names): 10 ** len(names) + 5 * (cube.DAY in names) for names in cube.SETS}
    assert cube.smallest_set(cube.needed_dimensions((cube.HOUR,)), sizes) == cube.HOUR
    weekdays = cube.needed_dimensions((cube.HOUR,), weekdays=("Monday",))
    assert cube.smallest_set(weekdays, sizes) == cube.set_name((cube.WEEKDAY, cube.HOUR))
    dated = cube.needed_dimensions((cube.HOUR,), dates=(1, 2), weekdays=("Monday",))
    assert cube.smallest_set(dated, sizes) == cube.set_name((cube.DAY, cube.HOUR))
    assert cube.smallest_set(frozenset(), sizes) == "all"
    with pytest.raises(KeyError, match="pickup_hour"):
        cube.smallest_set(frozenset([cube.HOUR]), {"all": 1})


@pytest.fixture(scope="module")
def sums(spark):
    random.seed(4)
    rows = [
        (dt.date(2023, 1, 1) + dt.timedelta(days=random.randrange(20)), random.randrange(24), random.choice(["A", "B", None]), random.randrange(1, 900) / 100)
        for _ in range(400)
    ]
    trips = spark.createDataFrame(rows, "pickup_date date, pickup_hour int, PU_Borough string, x double")
    columns = {name: F.col("x") for name in rollups.UNITS} | {"passenger_count": F.lit(1)}
    return trips.withColumns(columns)


@pytest.mark.parametrize("by", [(), (cube.HOUR,), (cube.BOROUGH,), (cube.WEEKDAY, cube.HOUR), (cube.DAY, cube.BOROUGH)])
@pytest.mark.parametrize("slicers", [{}, {"weekdays": ("Monday", "Friday")}, {"hours": (3, 9), "boroughs": ("A",)}, {"dates": (dt.date(2023, 1, 3), dt.date(2023, 1, 9)), "weekdays": ("Friday",)}])
def test_slices_equal_the_trips(spark, sums, by, slicers):
    stored = cube.cube_sums(rollups.monthly_trip_sums(sums))
    got = cube.cube_slice(stored, by, rollups.DAILY, **slicers)
    trips = sums.withColumn(cube.WEEKDAY, F.dayofweek("pickup_date"))
    want = rollups.grouped_measures(marts.sliced(trips, **slicers), by, rollups.DAILY, merged=False)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


# forecast -------------------------------------------------------------------------


def days_of(spark, values, start=dt.date(2023, 1, 1)):
    rows = [(start + dt.timedelta(days=i), int(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "pickup_date date, total_trips long").repartition(3)


def plain_fold(values, first, weights, level, season):
    trend, errors, season = 0.0, 0.0, list(season)
    for i, value in enumerate(values):
        place = (first + i) % 7
        known = level + trend
        error = 0.0 if value is None else value - (known + season[place])
        level, trend, errors = known + weights[0] * error, trend + weights[1] * error, errors + error * error
        season[place] += weights[2] * error
    return level, trend, season, errors


def plain_start(values, first):
    early = [(i, v) for i, v in enumerate(values[: forecast.WARM_UP]) if v is not None]
    level = sum(v for _, v in early) / len(early)
    season = []
    for place in range(7):
        mine = [v for i, v in early if (first + i) % 7 == place]
        season.append(sum(mine) / len(mine) - level if mine else 0.0)
    return level, season


def plain_forecast(values, start):
    first = (start - dt.date(1970, 1, 1)).days
    cut = max(len(values) - forecast.HELD_OUT, min(len(values), 1))
    train, test = values[:cut], values[cut : cut + forecast.HELD_OUT]
    grid = itertools.product(forecast.LEVELS, forecast.TRENDS, forecast.SEASONS)
    _, weights = min((plain_fold(train, first, w, *plain_start(train, first))[3], w) for w in grid)

    def ahead(state, last, n):
        return state[0] + state[1] * n + state[2][(last + n) % 7]

    state = plain_fold(train, first, weights, *plain_start(train, first))
    missed = [v - ahead(state, first + cut - 1, i + 1) for i, v in enumerate(test) if v is not None]
    rmse = (sum(e * e for e in missed) / len(missed)) ** 0.5 if missed else 0.0
    state = plain_fold(values, first, weights, *plain_start(values, first))
    return [ahead(state, first + len(values) - 1, n) for n in range(1, 31)], rmse


@pytest.mark.parametrize("size, gaps", [(200, 0), (150, 9), (40, 0), (5, 0), (1, 0)])
def test_forecast_equals_a_plain_fold(spark, size, gaps):
    random.seed(size)
    start = dt.date(2023, 1, 3)
    values = [500 + i + 200 * ((i + 2) % 7 in (5, 6)) + random.randrange(40) for i in range(size)]
    for i in random.sample(range(1, size - 1), gaps) if gaps else ():
        values[i] = None
    want, rmse = plain_forecast(values, start)
    rows = forecast.seasonal_forecast(days_of(spark, values, start)).orderBy("days_ahead").collect()
    assert [r.days_ahead for r in rows] == list(range(1, 31))
    assert rows[0].forecast_date == start + dt.timedelta(days=size)
    assert [r.forecast_trips for r in rows] == pytest.approx(want, abs=0.006)
    assert rows[4].upper_trips - rows[4].lower_trips == pytest.approx(2 * forecast.BOUND * rmse, abs=0.02)


def test_forecast_of_nothing(spark):
    assert forecast.seasonal_forecast(days_of(spark, [])).count() == 0


def test_the_season_beats_the_line(spark):
    random.seed(1)
    values = [3_000 + 2 * i + (900 if i % 7 in (4, 5) else -300) + random.gauss(0, 60) for i in range(228)]
    known, truth = values[:200], values[200:]
    line = marts.trip_forecast(days_of(spark, known), 28).orderBy("days_ahead").collect()
    season = forecast.seasonal_forecast(days_of(spark, known), 28).orderBy("days_ahead").collect()

    def error(rows):
        return (sum((r.forecast_trips - v) ** 2 for r, v in zip(rows, truth)) / 28) ** 0.5

    assert error(season) < 0.4 * error(line)
    assert sum(r.lower_trips <= v <= r.upper_trips for r, v in zip(season, truth)) >= 24
