"""Dashboard-ready tables derived from gold and analytics results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.calendar import weekday_name, year_month
from meterline.functions.numeric import CENTS, exact_mean, exact_sum, percent
from meterline.functions.trendline import fit_line
from meterline.operators.routes import busiest_routes

# Reference line, alert limit, horizon and list lengths of the dashboard.
SPEED_LIMIT_MPH = 25
MOM_ALERT_PCT = -10
FORECAST_DAYS = 30
PEAK_HOURS = 3
TOP_ROUTES = 20
ROUTE_ARROW = " → "


def daily_with_month(trends: DataFrame, monthly: DataFrame) -> DataFrame:
    """Every day next to the figures of its month."""
    return trends.withColumn("year_month", year_month("pickup_date")).join(monthly, "year_month")


def daily_with_hours(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    """Every day next to each of its hours."""
    days = daily.selectExpr("pickup_date", "total_trips AS day_trips", "total_revenue AS day_revenue")
    hours = hourly.select("pickup_date", "pickup_hour", "total_trips", "avg_fare", "avg_distance", "avg_speed")
    return days.join(hours, "pickup_date")


def routes_with_borough(top_routes: DataFrame, summary: DataFrame) -> DataFrame:
    """Top routes next to the totals of their pickup borough."""
    boroughs = summary.selectExpr(
        "PU_Borough", "total_trips AS borough_trips", "total_revenue AS borough_revenue", "revenue_rank"
    )
    routes = top_routes.select(
        "PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone", "total_trips", "total_revenue", "rank_by_volume"
    )
    return boroughs.join(routes, "PU_Borough")


def revenue_trend(monthly: DataFrame) -> DataFrame:
    """Monthly revenue with its average line and its linear trend over the months."""
    numbered = monthly.selectExpr(
        "year_month",
        "monthly_revenue",
        "row_number() OVER (ORDER BY year_month) AS month_index",
        f"CAST(rint(monthly_revenue * {CENTS}D) AS BIGINT) AS _cents",
    )
    fitted = numbered.withColumns(fit_line("month_index", "_cents", "OVER ()"))
    return fitted.selectExpr(
        "year_month",
        "month_index",
        "monthly_revenue",
        f"round(mean_y / {CENTS}, 2) AS average_revenue",
        f"round(slope / {CENTS}, 4) AS trend_slope",
        f"round((mean_y + slope * (month_index - mean_x)) / {CENTS}, 2) AS trend_revenue",
    )


def growth_alerts(monthly: DataFrame, limit_pct: float = MOM_ALERT_PCT) -> DataFrame:
    return monthly.selectExpr(
        "year_month",
        "mom_growth_pct",
        "CASE WHEN mom_growth_pct > 0 THEN 'up' WHEN mom_growth_pct < 0 THEN 'down' ELSE 'flat' END AS direction",
        f"IF(mom_growth_pct < {limit_pct}, 1, 0) AS alert",
    )


def trip_forecast(daily: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    """Straight-line projection of daily trips beyond the last day."""
    line = daily.agg(
        F.max("pickup_date").alias("last_date"),
        *[column.alias(name) for name, column in fit_line("unix_date(pickup_date)", "total_trips").items()],
    )
    ahead = line.filter("last_date IS NOT NULL").selectExpr("*", f"explode(sequence(1, {days})) AS days_ahead")
    return ahead.selectExpr(
        "date_add(last_date, days_ahead) AS forecast_date",
        "days_ahead",
        "round(mean_y + coalesce(slope, 0D) * (unix_date(last_date) + days_ahead - mean_x), 2) AS forecast_trips",
    )


def revenue_calendar(daily: DataFrame) -> DataFrame:
    """Revenue by ISO week and weekday."""
    return daily.groupBy(
        F.expr("extract(YEAROFWEEK FROM pickup_date) AS week_year"),
        F.expr("weekofyear(pickup_date) AS week"),
        F.expr("dayofweek(pickup_date) AS day_of_week"),
    ).agg(exact_sum("total_revenue", CENTS, 2).alias("total_revenue"))


def peak_hour_flags(peaks: DataFrame, n: int = PEAK_HOURS) -> DataFrame:
    """Hours ranked by trips, the first ``n`` flagged (24 rows reach the window)."""
    busiest = Window.orderBy(F.desc("total_trips_by_hour"), "pickup_hour")
    ranked = peaks.withColumn("hour_rank", F.row_number().over(busiest))
    return ranked.withColumn("is_peak", F.expr(f"IF(hour_rank <= {n}, 1, 0)"))


def speed_by_hour(heatmap: DataFrame, limit_mph: float = SPEED_LIMIT_MPH) -> DataFrame:
    speeds = heatmap.groupBy("pickup_hour").agg(exact_mean("avg_speed", CENTS, 2).alias("avg_speed"))
    return speeds.selectExpr(
        "pickup_hour",
        "avg_speed",
        f"{float(limit_mph)}D AS speed_limit",
        f"IF(avg_speed > {limit_mph}, 'above', 'within') AS against_limit",
    )


def flow_share(flow: DataFrame) -> DataFrame:
    return flow.select(
        "flow_type", "total_trips", percent("total_trips", "sum(total_trips) OVER ()").alias("share_pct")
    )


def labelled_top_routes(routes: DataFrame, n: int = TOP_ROUTES) -> DataFrame:
    return busiest_routes(routes, n).select(
        F.concat_ws(ROUTE_ARROW, "PU_Zone", "DO_Zone").alias("route"),
        "PU_Borough",
        "DO_Borough",
        "total_trips",
        "total_revenue",
        "rank_by_volume",
    )


def sliced(
    df: DataFrame,
    dates: tuple[dt.date, dt.date] | None = None,
    hours: tuple[int, int] | None = None,
    weekdays: tuple[str, ...] | None = None,
    boroughs: tuple[str, ...] | None = None,
) -> DataFrame:
    """Dashboard slicers as filters; a date range prunes the partitions of silver and gold."""
    if dates:
        df = df.filter(F.col("pickup_date").between(*dates))
    if hours:
        df = df.filter(F.col("pickup_hour").between(*hours))
    if weekdays:
        df = df.filter(weekday_name("dayofweek(pickup_date)").isin(*weekdays))
    if boroughs:
        df = df.filter(F.col("PU_Borough").isin(*boroughs))
    return df
