"""KPIs, trends and comparisons over the gold tables.

Windows here have no partition key; their input is one row per day or month, so
the calendar bounds it (3.7 million days between the years 1 and 9999).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.calendar import weekday_name, weekend_label, year_month
from meterline.functions.numeric import CENTS, THOUSANDTHS, exact_mean, exact_sum, percent

# Labels of the two ends of the ranking.
BEST_LABEL, WORST_LABEL = "Top 10 Days", "Bottom 10 Days"


def global_kpis(daily: DataFrame) -> DataFrame:
    """One row of headline figures; averages are means of the daily averages."""
    return daily.agg(
        F.expr("sum(total_trips) AS total_trips_ytd"),
        exact_sum("total_revenue", CENTS, 2).alias("total_revenue_ytd"),
        exact_mean("avg_fare", CENTS, 2).alias("avg_fare_ytd"),
        exact_mean("avg_distance", THOUSANDTHS, 2).alias("avg_distance_ytd"),
        exact_mean("avg_duration", CENTS, 2).alias("avg_duration_ytd"),
        F.expr("count(pickup_date) AS days_in_operation"),
        F.expr("round(try_divide(sum(total_trips), count(pickup_date)), 0) AS avg_trips_per_day"),
    )


def monthly_kpis(daily: DataFrame) -> DataFrame:
    """Monthly totals with growth over the previous month present in the data."""
    monthly = daily.groupBy(year_month("pickup_date").alias("year_month")).agg(
        F.sum("total_trips").alias("monthly_trips"),
        exact_sum("total_revenue", CENTS, 2).alias("monthly_revenue"),
        exact_mean("avg_fare", CENTS, 2).alias("monthly_avg_fare"),
    )
    growth = percent("monthly_trips - prev_month_trips", "prev_month_trips")
    return monthly.withColumn(
        "prev_month_trips", F.lag("monthly_trips").over(Window.orderBy("year_month"))
    ).withColumn("mom_growth_pct", F.when(F.isnotnull("prev_month_trips"), growth).otherwise(0.0))


def daily_trends(daily: DataFrame) -> DataFrame:
    """Trailing 7- and 30-row means; the frames count rows, so a missing day is no gap."""
    week, month = (f"OVER (ORDER BY pickup_date ROWS {n} PRECEDING)" for n in (6, 29))
    return daily.select(
        "pickup_date",
        "total_trips",
        "total_revenue",
        "avg_fare",
        "avg_distance",
        F.expr(f"round(avg(total_trips) {week}, 0) AS trips_ma7"),
        F.expr(f"round(avg(total_trips) {month}, 0) AS trips_ma30"),
        exact_mean("total_revenue", CENTS, 2, week).alias("revenue_ma7"),
        exact_mean("total_revenue", CENTS, 2, month).alias("revenue_ma30"),
        F.expr("dayofweek(pickup_date) AS day_of_week"),
        weekend_label("dayofweek(pickup_date)").alias("is_weekend"),
    )


def performance_ranking(daily: DataFrame, n: int = 10) -> DataFrame:
    """Best and worst ``n`` days by revenue; a day in both lists appears twice."""
    columns = ("pickup_date", "total_trips", "total_revenue", "avg_fare")
    revenue = F.col("total_revenue")
    ends = []
    for label, order in ((BEST_LABEL, revenue.desc_nulls_last()), (WORST_LABEL, revenue.asc_nulls_first())):
        days = daily.select(*columns).orderBy(order, "pickup_date").limit(n)
        ends.append(days.withColumn("rank_type", F.lit(label)))
    return ends[0].unionByName(ends[1])


def weekday_comparison(trends: DataFrame) -> DataFrame:
    return trends.groupBy("is_weekend").agg(
        F.expr("round(avg(total_trips), 0) AS avg_daily_trips"),
        exact_mean("total_revenue", CENTS, 2).alias("avg_daily_revenue"),
        exact_mean("avg_fare", CENTS, 2).alias("avg_fare"),
    )


def hourly_heatmap(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(
        weekday_name("dayofweek(pickup_date)").alias("day_name"),
        F.expr("dayofweek(pickup_date) AS day_of_week"),
        "pickup_hour",
    ).agg(
        F.expr("round(avg(total_trips), 0) AS avg_trips"),
        exact_mean("avg_fare", CENTS, 2).alias("avg_fare"),
        exact_mean("avg_speed", CENTS, 2).alias("avg_speed"),
    )


def peak_hours(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("pickup_hour").agg(
        F.sum("total_trips").alias("total_trips_by_hour"),
        exact_mean("avg_fare", CENTS, 2).alias("avg_fare_by_hour"),
    )


def borough_summary(borough: DataFrame) -> DataFrame:
    """Totals per borough with a dense revenue rank (one row per borough reaches the window)."""
    totals = borough.groupBy("PU_Borough").agg(
        F.sum("total_trips").alias("total_trips"),
        exact_sum("total_revenue", CENTS, 2).alias("total_revenue"),
        exact_mean("avg_fare", CENTS, 2).alias("avg_fare"),
        exact_mean("avg_distance", THOUSANDTHS, 2).alias("avg_distance"),
    )
    by_revenue = Window.orderBy(F.col("total_revenue").desc_nulls_last())
    return totals.withColumn("revenue_rank", F.dense_rank().over(by_revenue))
