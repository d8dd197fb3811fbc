"""Rankings and flows over the route table.

``orderBy`` next to ``limit`` plans as a distributed top-k; only the k surviving
rows reach the ranking window.  All keys take part in the order, so ties are
always cut the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.numeric import CENTS, THOUSANDTHS, exact_mean
from meterline.layout import ANALYTICS
from meterline.operators.rollups import ROUTE_KEYS

INTRA, INTER = "Intra-Borough", "Inter-Borough"


def _order(measure: str) -> list[Column]:
    return [F.col(measure).desc_nulls_last(), *[F.col(key).asc_nulls_first() for key in ROUTE_KEYS]]


def _top(routes: DataFrame, measure: str, n: int, rank_name: str | None = None) -> DataFrame:
    top = routes.orderBy(*_order(measure)).limit(n)
    if rank_name:
        top = top.withColumn(rank_name, F.row_number().over(Window.orderBy(*_order(measure))))
    return top


def busiest_routes(routes: DataFrame, n: int = 100) -> DataFrame:
    """Routes by trips, with revenue estimated from the average fare.

    The result is an analytics table, so its ``_layer`` tag says so.
    """
    top = _top(routes, "total_trips", n, "rank_by_volume")
    revenue = F.expr("round(total_trips * avg_fare, 2)")
    return top.withColumns({"total_revenue": revenue, "_layer": F.lit(ANALYTICS)})


def most_profitable_routes(routes: DataFrame, n: int = 100) -> DataFrame:
    priced = routes.withColumn("revenue_per_trip", F.col("avg_fare"))
    return _top(priced, "revenue_per_trip", n, "rank_by_profit")


def most_efficient_routes(routes: DataFrame, n: int = 100) -> DataFrame:
    """Revenue per mile; routes without distance are removed before the division."""
    moving = routes.filter("avg_distance > 0")
    per_mile = F.expr("round(try_divide(avg_fare, avg_distance), 2)")
    return _top(moving.withColumn("revenue_per_mile", per_mile), "revenue_per_mile", n)


def route_preview(routes: DataFrame, n: int = 10) -> DataFrame:
    return _top(routes, "total_trips", n).select("PU_Zone", "DO_Zone", "total_trips", "avg_fare")


def borough_flow(routes: DataFrame) -> DataFrame:
    """Trips within and between boroughs; an unknown borough counts as between."""
    kind = F.expr(f"IF(PU_Borough = DO_Borough, '{INTRA}', '{INTER}') AS flow_type")
    return routes.groupBy(kind).agg(
        F.sum("total_trips").alias("total_trips"),
        exact_mean("avg_fare", CENTS, 2).alias("avg_fare"),
        exact_mean("avg_distance", THOUSANDTHS, 2).alias("avg_distance"),
    )
