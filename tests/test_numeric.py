import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.functions.numeric import exact_mean, exact_sum, percent, round_half_up


def same(a, b):
    return (a is None and b is None) or a == b or (math.isnan(a) and math.isnan(b))


def rounding_cases():
    rng = random.Random(7)
    ties = [n / 1000 for n in range(-3000, 3000, 5)]
    noisy = [math.nextafter(x, s) for x in ties for s in (math.inf, -math.inf)]
    plain = [rng.uniform(-1e7, 1e7) for _ in range(3000)] + [rng.uniform(-2, 2) for _ in range(3000)]
    special = [0.0, -0.0, -0.001, 1e6, 1e18, -1e300, math.nan, math.inf, -math.inf, None, 1.005, 0.285]
    return ties + noisy + plain + special


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_rounding_equals_the_builtin(spark, digits):
    df = spark.createDataFrame([(x,) for x in rounding_cases()], "x double")
    rows = df.select(round_half_up("x", digits).alias("got"), F.round("x", digits).alias("want")).collect()
    assert all(same(r.got, r.want) for r in rows)
    assert not any(r.got == 0 and math.copysign(1, r.got) < 0 for r in rows if r.got is not None)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=60), st.integers(1, 7))
def test_sum_is_exact_and_order_free(spark, cents, parts):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    want = sum(cents) / 100
    for frame in (df, df.orderBy("x"), df.repartition(parts)):
        assert frame.agg(exact_sum("x", 100).alias("s")).first().s == want
    assert df.agg(exact_mean("x", 100).alias("m")).first().m == want / len(cents)


@pytest.mark.parametrize(
    "values, want",
    [
        ([1.25, None, 2.5], 3.75),
        ([None, None], None),
        ([1.0, math.nan], math.nan),
        ([1.0, math.inf], math.inf),
        ([1e300, 1.0], 1e300),
        ([-0.07, 0.05], -0.02),
    ],
)
def test_sum_of_unusual_values(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert same(df.agg(exact_sum("x", 100).alias("s")).first().s, want)


def test_mean_ignores_nulls_and_percent_tolerates_zero(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 0), (2.0, 0)], "x double, zero int")
    row = df.agg(exact_mean("x", 100, 2).alias("m"), percent("sum(x)", "sum(zero)").alias("p")).first()
    assert (row.m, row.p) == (1.5, None)


def test_wide_sums_do_not_overflow(spark):
    # 2^40 units per row over 2^24 rows exceeds a long when summed directly
    total = spark.range(1 << 24).selectExpr("1099511627776D AS x").agg(exact_sum("x", 1).alias("s")).first().s
    assert total == float(1 << 64)
