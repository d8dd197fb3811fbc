"""The registered queries as SQL, for checking results in a second engine.

Written from the semantics of each operator, as a chain of common table
expressions that mirrors the layers.
"""

from __future__ import annotations

import re

from meterline.layout import (
    BRONZE_STAMPS,
    REQUIRED_TRIP_COLUMNS,
    REQUIRED_ZONE_COLUMNS,
    TABLES,
)
from meterline.operators import forecast
from meterline.plans import queries as q

CENTS, MICROS = 100, 1_000_000


def half_up(x: str, digits: int) -> str:
    """Decimal rounding of the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def total(x: str, per_one: int, over: str = "") -> str:
    return f"(CAST(sum(CAST(round({x} * {per_one}) AS BIGINT)) {over} AS DOUBLE) / {per_one})"


def mean(x: str, per_one: int, over: str = "") -> str:
    return f"({total(x, per_one, over)} / count({x}) {over})"


def count_sum(x: str, over: str = "") -> str:
    return f"CAST(sum({x}) {over} AS BIGINT)"


def plain_mean(x: str, over: str = "") -> str:
    return f"(CAST(sum({x}) {over} AS DOUBLE) / count({x}) {over})"


def money(x: str) -> str:
    return half_up(total(x, CENTS), 2)


def passed(condition: str, otherwise: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASSED' ELSE '{otherwise}' END"


RULES = {
    "fare_positive": "fare_amount > 0",
    "total_positive": "total_amount > 0",
    "distance_positive": "trip_distance > 0",
    "distance_below_100": "trip_distance < 100",
    "passengers_1_to_6": "passenger_count BETWEEN 1 AND 6",
    "pickup_before_dropoff": "tpep_pickup_datetime < tpep_dropoff_datetime",
    "pickup_zone_known": "PULocationID IS NOT NULL",
    "dropoff_zone_known": "DOLocationID IS NOT NULL",
}
ACCEPTED = " AND ".join(RULES.values())
WEEKEND = "CASE WHEN {0} IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END"
DAY_OF_WEEK = "CAST(dayofweek({0}) + 1 AS INTEGER)"
ROUTE_KEYS = "PU_Borough, PU_Zone, DO_Borough, DO_Zone"
ROUTE_TIES = ", ".join(f"{key} ASC NULLS FIRST" for key in ROUTE_KEYS.split(", "))

_FARE, _DISTANCE = half_up(mean("fare_amount", CENTS), 2), half_up(mean("trip_distance", MICROS), 3)

CTES = {
    "lens": """
        SELECT l_orderkey AS trip_key, l_linenumber AS trip_line,
               o_orderdate + to_seconds(p) AS tpep_pickup_datetime,
               o_orderdate + to_seconds(p + len) AS tpep_dropoff_datetime,
               CASE WHEN NOT (l_linenumber = 1 AND l_partkey % 11 = 0)
                    THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count,
               l_quantity * CAST(2.1 AS DOUBLE) - CAST(3 AS DOUBLE) AS trip_distance,
               price - CAST(2 AS DOUBLE) AS fare_amount,
               price * (CAST(1 AS DOUBLE) + l_tax) - CAST(1 AS DOUBLE) AS total_amount,
               l_extendedprice * l_tax / CAST(1000 AS DOUBLE) AS tip_amount,
               CASE WHEN l_partkey % 97 <> 0 THEN c_nationkey END AS PULocationID,
               CASE WHEN l_suppkey % 53 = 0 THEN s_nationkey + 1000
                    WHEN l_partkey % 89 <> 0 THEN s_nationkey END AS DOLocationID
        FROM (SELECT *,
                     (l_orderkey * 7919 + l_partkey * 31 + l_suppkey * 17) % 86400 AS p,
                     (l_partkey * 13 + l_suppkey * 97 + l_linenumber * 61) % 5400 - 60 AS len,
                     l_extendedprice * (CAST(1 AS DOUBLE) - l_discount) / CAST(1000 AS DOUBLE) AS price
              FROM lineitem)
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "zones_raw": """
        SELECT n_nationkey AS LocationID, '  ' || lower(r_name) || ' ' AS Borough, ' ' || n_name AS Zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "bronze": f"""
        SELECT *, DATE '{q.RUN_DATE}' AS _ingestion_date, 'bronze' AS _layer FROM lens""",
    "typed": """
        SELECT * REPLACE (CAST(trunc(passenger_count) AS INTEGER) AS passenger_count),
               CAST(tpep_pickup_datetime AS DATE) AS pickup_date
        FROM bronze""",
    "filtered": f"SELECT * FROM typed WHERE {ACCEPTED}",
    "features": f"""
        SELECT * REPLACE ({half_up('fare_amount', 2)} AS fare_amount,
                          {half_up('total_amount', 2)} AS total_amount),
               minutes AS trip_duration_minutes,
               CASE WHEN minutes > 0 THEN {half_up('trip_distance / (minutes / 60)', 2)} ELSE 0 END AS avg_speed_mph,
               CASE WHEN fare_amount > 0 THEN {half_up('tip_amount / fare_amount * 100', 2)} ELSE 0 END AS tip_percentage,
               CASE WHEN trip_distance > 0 THEN {half_up('fare_amount / trip_distance', 2)} ELSE 0 END AS fare_per_mile,
               CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
               {DAY_OF_WEEK.format('pickup_date')} AS pickup_dayofweek,
               CAST(day(pickup_date) AS INTEGER) AS pickup_day,
               CAST(month(pickup_date) AS INTEGER) AS pickup_month,
               CAST(year(pickup_date) AS INTEGER) AS pickup_year,
               CASE WHEN hour(tpep_pickup_datetime) BETWEEN 6 AND 11 THEN 'Morning'
                    WHEN hour(tpep_pickup_datetime) BETWEEN 12 AND 17 THEN 'Afternoon'
                    WHEN hour(tpep_pickup_datetime) BETWEEN 18 AND 21 THEN 'Evening'
                    ELSE 'Night' END AS time_period,
               {WEEKEND.format('dayofweek(pickup_date) + 1')} AS day_type
        FROM (SELECT *, date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60 AS minutes
              FROM filtered)""",
    "zones": "SELECT LocationID, upper(trim(Borough)) AS Borough, trim(Zone) AS Zone FROM zones_raw",
    "silver": """
        SELECT f.* EXCLUDE (minutes) REPLACE ('silver' AS _layer),
               pu.Borough AS PU_Borough, pu.Zone AS PU_Zone,
               dz.Borough AS DO_Borough, dz.Zone AS DO_Zone
        FROM features f
        LEFT JOIN zones pu ON f.PULocationID = pu.LocationID
        LEFT JOIN zones dz ON f.DOLocationID = dz.LocationID""",
    "daily": f"""
        SELECT pickup_date, count(*) AS total_trips, {money('fare_amount')} AS total_fare,
               {money('total_amount')} AS total_revenue, {_FARE} AS avg_fare, {_DISTANCE} AS avg_distance,
               {half_up(mean('trip_duration_minutes', 60), 2)} AS avg_duration,
               {half_up(mean('tip_percentage', CENTS), 2)} AS avg_tip_pct,
               {count_sum('passenger_count')} AS total_passengers, 'gold' AS _layer
        FROM features GROUP BY pickup_date""",
    "hourly": f"""
        SELECT pickup_date, pickup_hour, count(*) AS total_trips, {_FARE} AS avg_fare,
               {_DISTANCE} AS avg_distance, {half_up(mean('avg_speed_mph', CENTS), 2)} AS avg_speed,
               'gold' AS _layer
        FROM features GROUP BY pickup_date, pickup_hour""",
    "borough": f"""
        SELECT pickup_date, PU_Borough, count(*) AS total_trips, {money('total_amount')} AS total_revenue,
               {_FARE} AS avg_fare, {_DISTANCE} AS avg_distance, 'gold' AS _layer
        FROM silver WHERE PU_Borough IS NOT NULL GROUP BY pickup_date, PU_Borough""",
    "routes": f"""
        SELECT {ROUTE_KEYS}, count(*) AS total_trips, {_FARE} AS avg_fare, {_DISTANCE} AS avg_distance,
               'gold' AS _layer
        FROM silver WHERE PU_Zone IS NOT NULL AND DO_Zone IS NOT NULL GROUP BY {ROUTE_KEYS}""",
    "monthly": f"""
        SELECT *, CASE WHEN prev_month_trips IS NOT NULL
                       THEN {half_up('(monthly_trips - prev_month_trips) / prev_month_trips * 100', 2)}
                       ELSE 0 END AS mom_growth_pct
        FROM (SELECT *, lag(monthly_trips) OVER (ORDER BY year_month) AS prev_month_trips
              FROM (SELECT strftime(pickup_date, '%Y-%m') AS year_month,
                           {count_sum('total_trips')} AS monthly_trips,
                           {money('total_revenue')} AS monthly_revenue,
                           {half_up(mean('avg_fare', CENTS), 2)} AS monthly_avg_fare
                    FROM daily GROUP BY 1))""",
    "trends": f"""
        SELECT pickup_date, total_trips, total_revenue, avg_fare, avg_distance,
               {half_up(plain_mean('total_trips', 'OVER w7'), 0)} AS trips_ma7,
               {half_up(plain_mean('total_trips', 'OVER w30'), 0)} AS trips_ma30,
               {half_up(mean('total_revenue', CENTS, 'OVER w7'), 2)} AS revenue_ma7,
               {half_up(mean('total_revenue', CENTS, 'OVER w30'), 2)} AS revenue_ma30,
               {DAY_OF_WEEK.format('pickup_date')} AS day_of_week,
               {WEEKEND.format('dayofweek(pickup_date) + 1')} AS is_weekend
        FROM daily
        WINDOW w7 AS (ORDER BY pickup_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w30 AS (ORDER BY pickup_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "heatmap": f"""
        SELECT dayname(pickup_date) AS day_name, {DAY_OF_WEEK.format('pickup_date')} AS day_of_week, pickup_hour,
               {half_up(plain_mean('total_trips'), 0)} AS avg_trips,
               {half_up(mean('avg_fare', CENTS), 2)} AS avg_fare,
               {half_up(mean('avg_speed', CENTS), 2)} AS avg_speed
        FROM hourly GROUP BY 1, 2, 3""",
    "peaks": f"""
        SELECT pickup_hour, {count_sum('total_trips')} AS total_trips_by_hour,
               {half_up(mean('avg_fare', CENTS), 2)} AS avg_fare_by_hour
        FROM hourly GROUP BY pickup_hour""",
    "top_volume": f"""
        SELECT * REPLACE ('analytics' AS _layer), {half_up('total_trips * avg_fare', 2)} AS total_revenue,
               CAST(row_number() OVER (ORDER BY total_trips DESC, {ROUTE_TIES}) AS INTEGER) AS rank_by_volume
        FROM (SELECT * FROM routes ORDER BY total_trips DESC, {ROUTE_TIES} LIMIT 100)""",
    "flow": f"""
        SELECT CASE WHEN PU_Borough = DO_Borough THEN 'Intra-Borough' ELSE 'Inter-Borough' END AS flow_type,
               {count_sum('total_trips')} AS total_trips,
               {half_up(mean('avg_fare', CENTS), 2)} AS avg_fare,
               {half_up(mean('avg_distance', 1000), 2)} AS avg_distance
        FROM routes GROUP BY 1""",
    "summary": f"""
        SELECT *, CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
        FROM (SELECT PU_Borough, {count_sum('total_trips')} AS total_trips,
                     {money('total_revenue')} AS total_revenue,
                     {half_up(mean('avg_fare', CENTS), 2)} AS avg_fare,
                     {half_up(mean('avg_distance', 1000), 2)} AS avg_distance
              FROM borough GROUP BY PU_Borough)""",
    "kpi": f"""
        SELECT {count_sum('total_trips')} AS total_trips_ytd, {money('total_revenue')} AS total_revenue_ytd,
               {half_up(mean('avg_fare', CENTS), 2)} AS avg_fare_ytd,
               {half_up(mean('avg_distance', 1000), 2)} AS avg_distance_ytd,
               {half_up(mean('avg_duration', CENTS), 2)} AS avg_duration_ytd,
               count(pickup_date) AS days_in_operation,
               {half_up('CAST(sum(total_trips) AS DOUBLE) / count(pickup_date)', 0)} AS avg_trips_per_day
        FROM daily""",
}

# Stored tables by their common table expression.
STORED = dict(
    zip(
        TABLES,
        (
            "bronze",
            "zones_raw",
            "silver",
            "daily",
            "hourly",
            "borough",
            "routes",
            "monthly",
            "trends",
            "heatmap",
            "top_volume",
            "kpi",
        ),
        strict=True,
    )
)

CHECKS = (
    ("data_exists", "volume", "count(*)", False),
    (
        "critical_columns_not_null",
        "completeness",
        "count(*) FILTER (WHERE tpep_pickup_datetime IS NULL OR fare_amount IS NULL OR trip_distance IS NULL)",
        True,
    ),
    ("fare_positive", "validity", "count(*) FILTER (WHERE fare_amount <= 0)", True),
    ("distance_positive", "validity", "count(*) FILTER (WHERE trip_distance <= 0)", True),
    ("passengers_valid", "validity", "count(*) FILTER (WHERE passenger_count NOT BETWEEN 1 AND 6)", True),
    ("speed_reasonable", "validity", "count(*) FILTER (WHERE avg_speed_mph > 100)", True),
    (
        "time_period_valid",
        "validity",
        "count(*) FILTER (WHERE time_period NOT IN ('Morning', 'Afternoon', 'Evening', 'Night'))",
        True,
    ),
    (
        "pickup_before_dropoff",
        "consistency",
        "count(*) FILTER (WHERE tpep_pickup_datetime >= tpep_dropoff_datetime)",
        True,
    ),
)


def _check_rows() -> str:
    rows = []
    for name, kind, count, zero in CHECKS:
        expected, test = ("= 0", "n = 0") if zero else ("> 0", "n > 0")
        rows.append(
            f"SELECT '{name}' AS check_name, '{kind}' AS check_type, {passed(test, 'FAILED')} AS status, "
            f"'{expected}' AS expected_value, CAST(n AS VARCHAR) AS actual_value, "
            f"CAST(0 AS DOUBLE) AS threshold FROM (SELECT {count} AS n FROM silver)"
        )
    return " UNION ALL ".join(rows)


def _filter_audit() -> str:
    rejected = ", ".join(
        f"count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS rejected_{name}" for name, rule in RULES.items()
    )
    accepted = f"count(*) FILTER (WHERE {ACCEPTED})"
    share = half_up(f"CAST(count(*) - {accepted} AS DOUBLE) / count(*) * 100", 2)
    return (
        f"SELECT count(*) AS rows_before, {accepted} AS rows_after, {rejected}, "
        f"count(*) - {accepted} AS rows_removed, {share} AS removed_pct FROM typed"
    )


def _null_profile() -> str:
    share = half_up("CAST(n AS DOUBLE) / rows * 100", 4)
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, n AS null_count, {share} AS null_pct, "
        f"CASE WHEN {share} > 5 THEN 'WARNING' ELSE 'PASSED' END AS status "
        f"FROM (SELECT count(*) AS rows, count(*) - count({name}) AS n FROM bronze)"
        for name in REQUIRED_TRIP_COLUMNS
    )


def _columns() -> str:
    wanted = [("bronze.trips", "bronze", name) for name in REQUIRED_TRIP_COLUMNS]
    wanted += [("bronze.taxi_zone_lookup", "zones_raw", name) for name in REQUIRED_ZONE_COLUMNS]
    rows = [
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, count({name}) AS filled_rows, "
        f"'PASSED' AS status FROM {cte}"
        for table, cte, name in wanted
    ]
    rows += [
        f"SELECT 'bronze.trips', '{name}', count(*), 'PASSED' FROM bronze" for name in BRONZE_STAMPS
    ]
    return " UNION ALL ".join(rows)


def _row_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{key}' AS table_name, count(*) AS record_count FROM {cte}" for key, cte in STORED.items()
    )


def _min_records() -> str:
    return " UNION ALL ".join(
        f"SELECT '{key}' AS table_name, '{TABLES[key].layer}' AS layer, count(*) AS record_count, "
        f"CAST({TABLES[key].min_records} AS BIGINT) AS min_records, "
        f"{passed(f'count(*) >= {TABLES[key].min_records}', 'WARNING')} AS status FROM {cte}"
        for key, cte in STORED.items()
    )


def _layer_values() -> str:
    return " UNION ALL ".join(
        f"SELECT '{key}' AS table_name, '{TABLES[key].layer}' AS layer_value, count(*) AS record_count, "
        f"'PASSED' AS status FROM {cte}"
        for key, cte in STORED.items()
        if TABLES[key].tagged
    )


# Result behind each export, and its number of columns.
_EXPORTS = {
    "kpi_global": ("kpi", 7),
    "kpi_monthly": ("monthly", 6),
    "daily_trends": ("trends", 11),
    "hourly_heatmap": ("heatmap", 6),
    "peak_hours": ("peaks", 3),
    "top_routes_volume": ("top_volume", 11),
    "borough_flow": ("flow", 4),
    "borough_summary": ("summary", 6),
}


def _exports() -> str:
    rows = [
        ("weekday_comparison", "SELECT DISTINCT is_weekend FROM trends", 4),
        ("performance_ranking", _performance_ranking(), 5),
        ("top_routes_profit", "SELECT 1 FROM routes LIMIT 100", 11),
        ("route_efficiency", "SELECT 1 FROM routes WHERE avg_distance > 0 LIMIT 100", 10),
        *[(name, f"SELECT 1 FROM {cte}", columns) for name, (cte, columns) in _EXPORTS.items()],
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS export_name, {columns} AS columns_exported, count(*) AS rows_expected, "
        f"count(*) AS rows_exported, 'PASSED' AS status FROM ({sql})"
        for name, sql, columns in rows
    )


def _silver_nulls() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) - count({name}) AS null_count, "
        f"{passed(f'count(*) = count({name})', 'WARNING')} AS status FROM silver"
        for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount")
    )


_SANITY = f"""
    SELECT {count_sum('total_trips')} AS total_trips, {money('total_revenue')} AS total_revenue,
           CAST(10000 AS BIGINT) AS minimum,
           {passed(f"sum(total_trips) >= 10000 AND {money('total_revenue')} >= 10000", 'WARNING')} AS status
    FROM daily"""

# Worst status per table: volume for all, filled columns for silver, totals for daily.
_TABLE_STATUS = f"""
    SELECT table_name, record_count,
           CASE WHEN status <> 'PASSED'
                  OR (table_name = 'silver.trips_cleaned'
                      AND EXISTS (SELECT 1 FROM ({_silver_nulls()}) WHERE status <> 'PASSED'))
                  OR (table_name = 'gold.trips_daily_metrics'
                      AND EXISTS (SELECT 1 FROM ({_SANITY}) WHERE status <> 'PASSED'))
                THEN 'WARNING' ELSE 'PASSED' END AS status
    FROM ({_min_records()})"""

_RECONCILE = """
    SELECT check_name, expected, actual,
           CASE WHEN expected = actual THEN 'PASSED' ELSE 'FAILED' END AS status
    FROM (
        SELECT 'silver_keeps_accepted' AS check_name, (SELECT count(*) FROM silver) AS expected,
               (SELECT count(*) FROM filtered) AS actual
        UNION ALL SELECT 'daily_covers_silver', (SELECT count(*) FROM silver),
               (SELECT CAST(sum(total_trips) AS BIGINT) FROM daily)
        UNION ALL SELECT 'hourly_covers_silver', (SELECT count(*) FROM silver),
               (SELECT CAST(sum(total_trips) AS BIGINT) FROM hourly)
        UNION ALL SELECT 'borough_covers_known', (SELECT count(PU_Borough) FROM silver),
               (SELECT CAST(sum(total_trips) AS BIGINT) FROM borough)
        UNION ALL SELECT 'routes_cover_known',
               (SELECT count(*) FROM silver WHERE PU_Zone IS NOT NULL AND DO_Zone IS NOT NULL),
               (SELECT CAST(sum(total_trips) AS BIGINT) FROM routes))"""


def _fit(x: str, y: str, source: str) -> str:
    """Slope and means of the least-squares line, from integer sums."""
    return f"""
        SELECT CAST(n * sxy - sx * sy AS DOUBLE) / CAST(n * sxx - sx * sx AS DOUBLE) AS slope,
               CAST(sx AS DOUBLE) / CAST(n AS DOUBLE) AS mean_x, CAST(sy AS DOUBLE) / CAST(n AS DOUBLE) AS mean_y
        FROM (SELECT CAST(count(*) AS HUGEINT) AS n, sum(CAST({x} AS HUGEINT)) AS sx, sum(CAST({y} AS HUGEINT)) AS sy,
                     sum(CAST({x} AS HUGEINT) * CAST({y} AS HUGEINT)) AS sxy,
                     sum(CAST({x} AS HUGEINT) * CAST({x} AS HUGEINT)) AS sxx
              FROM {source})"""


_NUMBERED = """
    SELECT year_month, monthly_revenue, CAST(row_number() OVER (ORDER BY year_month) AS INTEGER) AS month_index,
           CAST(round(monthly_revenue * 100) AS BIGINT) AS cents
    FROM monthly"""
_UNIX_DAY = "CAST(date_diff('day', DATE '1970-01-01', {0}) AS BIGINT)"

_FORECAST_VALUE = half_up(
    f"mean_y + slope * ({_UNIX_DAY.format('last_date')} + days_ahead - mean_x)", 2
)


def _performance_ranking() -> str:
    columns = "pickup_date, total_trips, total_revenue, avg_fare"
    return f"""
        SELECT * FROM (SELECT {columns}, 'Top 10 Days' AS rank_type FROM daily
                       ORDER BY total_revenue DESC NULLS LAST, pickup_date LIMIT 10)
        UNION ALL
        SELECT * FROM (SELECT {columns}, 'Bottom 10 Days' AS rank_type FROM daily
                       ORDER BY total_revenue ASC NULLS FIRST, pickup_date LIMIT 10)"""


def _sliced_hourly() -> str:
    def quoted(names):
        return ", ".join(f"'{name}'" for name in names)

    first, last = q.SLICE_DATES
    low, high = q.SLICE_HOURS
    source = CTES["hourly"].replace("FROM features", "FROM silver WHERE {0}")
    return source.format(
        f"pickup_date BETWEEN DATE '{first}' AND DATE '{last}' AND pickup_hour BETWEEN {low} AND {high} "
        f"AND dayname(pickup_date) IN ({quoted(q.SLICE_WEEKDAYS)}) AND PU_Borough IN ({quoted(q.SLICE_BOROUGHS)})"
    )


def _refreshed_borough() -> str:
    corrected = (
        "(SELECT * REPLACE (CASE WHEN strftime(pickup_date, '%Y-%m') = "
        f"'{q.CORRECTED_MONTH}' THEN total_amount + 1 ELSE total_amount END AS total_amount) FROM silver)"
    )
    return CTES["borough"].replace("FROM silver", f"FROM {corrected}")


def _quoted(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{name}'" for name in names)


_SLICED_DATES = "pickup_date BETWEEN DATE '{}' AND DATE '{}'".format(*q.SLICE_DATES)
_SLICED_HOURS = "pickup_hour BETWEEN {} AND {}".format(*q.SLICE_HOURS)
_SPEED = half_up(mean("avg_speed_mph", CENTS), 2)


def _changed_days() -> str:
    """Rows of the month that differ: changed ones are missing and surplus, lost ones only missing."""
    return f"""
        SELECT pickup_date, CAST(count(*) AS BIGINT) AS expected_rows,
               CAST(count(*) - count(*) FILTER (lost) AS BIGINT) AS actual_rows,
               CAST(count(*) FILTER (changed OR lost) AS BIGINT) AS missing,
               CAST(count(*) FILTER (changed) AS BIGINT) AS surplus
        FROM (SELECT pickup_date, PULocationID = {q.CHANGED_ZONE} AS changed,
                     PULocationID = {q.LOST_ZONE} AND dayofweek(pickup_date) = 1 AS lost
              FROM silver WHERE strftime(pickup_date, '%Y-%m') = '{q.CORRECTED_MONTH}')
        GROUP BY pickup_date HAVING count(*) FILTER (changed OR lost) > 0"""


_UNION_BY_NAME = f"""
    SELECT trip_key, trip_line, trip_distance,
           CASE WHEN early THEN passenger_count ELSE CAST(CAST(passenger_count AS BIGINT) AS DOUBLE) END AS passenger_count,
           CASE WHEN PULocationID % 5 = 0 THEN CAST(1.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Airport_fee,
           CASE WHEN NOT early THEN tip_amount END AS extra
    FROM (SELECT *, tpep_pickup_datetime < TIMESTAMP '{q.SCHEMA_CHANGE}' AS early FROM lens)"""

QUERIES = {
    "bronze_trips": "SELECT * FROM bronze",
    "bronze_union_by_name": _UNION_BY_NAME,
    "silver_typed": "SELECT * FROM typed",
    "silver_filtered": "SELECT * FROM filtered",
    "silver_filter_audit": _filter_audit(),
    "silver_features": "SELECT * EXCLUDE (minutes) FROM features",
    "zones_clean": "SELECT * FROM zones",
    "silver_enriched": "SELECT * FROM silver",
    "gold_daily": "SELECT * FROM daily",
    "gold_hourly": "SELECT * FROM hourly",
    "gold_borough": "SELECT * FROM borough",
    "gold_borough_revenue": f"SELECT PU_Borough, {money('total_revenue')} AS revenue FROM borough GROUP BY PU_Borough",
    "gold_routes": "SELECT * FROM routes",
    "gold_top_routes": f"""
        SELECT PU_Zone, DO_Zone, total_trips, avg_fare FROM routes
        ORDER BY total_trips DESC, {ROUTE_TIES} LIMIT 10""",
    "kpi_global": "SELECT * FROM kpi",
    "kpi_monthly": "SELECT * FROM monthly",
    "performance_ranking": _performance_ranking(),
    "daily_trends": "SELECT * FROM trends",
    "weekday_comparison": f"""
        SELECT is_weekend, {half_up(plain_mean('total_trips'), 0)} AS avg_daily_trips,
               {half_up(mean('total_revenue', CENTS), 2)} AS avg_daily_revenue,
               {half_up(mean('avg_fare', CENTS), 2)} AS avg_fare
        FROM trends GROUP BY is_weekend""",
    "hourly_heatmap": "SELECT * FROM heatmap",
    "peak_hours": "SELECT * FROM peaks",
    "top_routes_volume": "SELECT * FROM top_volume",
    "top_routes_profit": f"""
        SELECT *, CAST(row_number() OVER (ORDER BY revenue_per_trip DESC NULLS LAST, {ROUTE_TIES}) AS INTEGER)
               AS rank_by_profit
        FROM (SELECT *, avg_fare AS revenue_per_trip FROM routes
              ORDER BY avg_fare DESC NULLS LAST, {ROUTE_TIES} LIMIT 100)""",
    "route_efficiency": f"""
        SELECT *, {half_up('avg_fare / avg_distance', 2)} AS revenue_per_mile
        FROM routes WHERE avg_distance > 0
        ORDER BY revenue_per_mile DESC NULLS LAST, {ROUTE_TIES} LIMIT 100""",
    "borough_flow": "SELECT * FROM flow",
    "borough_summary": "SELECT * FROM summary",
    "dq_checks": _check_rows(),
    "dq_summary": f"""
        SELECT count(*) AS checks_run, count(*) FILTER (WHERE status = 'PASSED') AS checks_passed,
               count(*) FILTER (WHERE status = 'FAILED') AS checks_failed,
               {half_up("CAST(count(*) FILTER (WHERE status = 'PASSED') AS DOUBLE) / count(*) * 100", 1)} AS pass_rate,
               coalesce(string_agg(CASE WHEN status = 'FAILED' THEN check_name END, ',' ORDER BY check_name), '')
                   AS failed_checks
        FROM ({_check_rows()})""",
    "dq_stats": f"""
        SELECT {mean('trip_distance', MICROS)} AS avg_distance, min(trip_distance) AS min_distance,
               max(trip_distance) AS max_distance, {mean('fare_amount', CENTS)} AS avg_fare,
               {mean('avg_speed_mph', CENTS)} AS avg_speed
        FROM features""",
    "dq_borough_distribution": """
        SELECT PU_Borough, count(*) AS trips FROM silver GROUP BY PU_Borough
        ORDER BY trips DESC, PU_Borough ASC NULLS FIRST LIMIT 10""",
    "dq_null_profile": _null_profile(),
    "dq_zone_boroughs": f"""
        SELECT Borough AS borough, count(*) AS zones, count(*) OVER () AS borough_count,
               {passed('count(*) OVER () >= 5', 'WARNING')} AS status
        FROM zones_raw GROUP BY Borough""",
    "dq_silver_nulls": _silver_nulls(),
    "dq_gold_sanity": _SANITY,
    "dq_columns": _columns(),
    "row_counts": _row_counts(),
    "dq_min_records": _min_records(),
    "dq_layer_values": _layer_values(),
    "dq_layer_status": f"""
        SELECT split_part(table_name, '.', 1) AS layer, count(*) AS tables,
               count(*) FILTER (WHERE status = 'PASSED') AS passed,
               count(*) FILTER (WHERE status = 'WARNING') AS warnings,
               count(*) FILTER (WHERE status = 'FAILED') AS failed,
               CAST(sum(record_count) AS BIGINT) AS records,
               CASE WHEN count(*) FILTER (WHERE status <> 'PASSED') = 0 THEN 'PASSED' ELSE 'ISSUES FOUND' END AS verdict
        FROM ({_TABLE_STATUS}) GROUP BY 1""",
    "dq_overall_status": f"""
        SELECT count(*) AS tables,
               {half_up("CAST(count(*) FILTER (WHERE status = 'PASSED') AS DOUBLE) / count(*) * 100", 1)} AS pass_rate,
               CAST(sum(record_count) AS BIGINT) AS records,
               CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED'
                    WHEN count(*) FILTER (WHERE status = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASSED' END AS verdict
        FROM ({_TABLE_STATUS})""",
    "dq_reconcile": _RECONCILE,
    "dq_exports": _exports(),
    "mart_daily_with_month": """
        SELECT t.*, m.* FROM trends t JOIN monthly m ON strftime(t.pickup_date, '%Y-%m') = m.year_month""",
    "mart_daily_hourly": """
        SELECT d.pickup_date, d.total_trips AS day_trips, d.total_revenue AS day_revenue,
               h.pickup_hour, h.total_trips, h.avg_fare, h.avg_distance, h.avg_speed
        FROM daily d JOIN hourly h USING (pickup_date)""",
    "mart_routes_with_borough": f"""
        SELECT r.PU_Borough, s.total_trips AS borough_trips, s.total_revenue AS borough_revenue, s.revenue_rank,
               r.PU_Zone, r.DO_Borough, r.DO_Zone, r.total_trips, r.total_revenue, r.rank_by_volume
        FROM summary s JOIN top_volume r ON s.PU_Borough = r.PU_Borough""",
    "mart_revenue_trend": f"""
        SELECT year_month, month_index, monthly_revenue, {half_up('mean_y / 100', 2)} AS average_revenue,
               {half_up('slope / 100', 4)} AS trend_slope,
               {half_up('(mean_y + slope * (month_index - mean_x)) / 100', 2)} AS trend_revenue
        FROM ({_NUMBERED}) CROSS JOIN ({_fit('month_index', 'cents', f'({_NUMBERED})')})""",
    "mart_mom_alerts": """
        SELECT year_month, mom_growth_pct,
               CASE WHEN mom_growth_pct > 0 THEN 'up' WHEN mom_growth_pct < 0 THEN 'down' ELSE 'flat' END AS direction,
               CAST(coalesce(mom_growth_pct < -10, false) AS INTEGER) AS alert
        FROM monthly""",
    "mart_forecast_30d": f"""
        SELECT CAST(last_date + CAST(days_ahead AS INTEGER) AS DATE) AS forecast_date,
               CAST(days_ahead AS INTEGER) AS days_ahead, {_FORECAST_VALUE} AS forecast_trips
        FROM ({_fit(_UNIX_DAY.format('pickup_date'), 'total_trips', 'daily')})
        CROSS JOIN (SELECT max(pickup_date) AS last_date FROM daily)
        CROSS JOIN (SELECT unnest(generate_series(1, 30)) AS days_ahead)""",
    "mart_revenue_calendar": f"""
        SELECT CAST(isoyear(pickup_date) AS INTEGER) AS week_year, CAST(week(pickup_date) AS INTEGER) AS week,
               {DAY_OF_WEEK.format('pickup_date')} AS day_of_week, {money('total_revenue')} AS total_revenue
        FROM daily GROUP BY 1, 2, 3""",
    "mart_peak_top3": """
        SELECT *, CAST(hour_rank <= 3 AS INTEGER) AS is_peak
        FROM (SELECT *, CAST(row_number() OVER (ORDER BY total_trips_by_hour DESC, pickup_hour) AS INTEGER) AS hour_rank
              FROM peaks)""",
    "mart_speed_by_hour": f"""
        SELECT *, CAST(25 AS DOUBLE) AS speed_limit,
               CASE WHEN avg_speed > 25 THEN 'above' ELSE 'within' END AS against_limit
        FROM (SELECT pickup_hour, {half_up(mean('avg_speed', CENTS), 2)} AS avg_speed FROM heatmap GROUP BY 1)""",
    "mart_flow_share": f"""
        SELECT flow_type, total_trips,
               {half_up('CAST(total_trips AS DOUBLE) / sum(total_trips) OVER () * 100', 2)} AS share_pct
        FROM flow""",
    "mart_top20_routes": f"""
        SELECT PU_Zone || ' → ' || DO_Zone AS route, PU_Borough, DO_Borough, total_trips, total_revenue, rank_by_volume
        FROM top_volume WHERE rank_by_volume <= 20""",
    "mart_sliced_hourly": _sliced_hourly(),
    "partition_refresh": _refreshed_borough(),
    "cube_hours": f"""
        SELECT pickup_hour, count(*) AS total_trips, {_FARE} AS avg_fare, {_DISTANCE} AS avg_distance, {_SPEED} AS avg_speed
        FROM silver WHERE dayname(pickup_date) IN ({_quoted(q.SLICE_WEEKDAYS)})
                      AND PU_Borough IN ({_quoted(q.SLICE_BOROUGHS)}) GROUP BY pickup_hour""",
    "cube_boroughs": f"""
        SELECT PU_Borough, count(*) AS total_trips, {money('total_amount')} AS total_revenue, {_FARE} AS avg_fare,
               {_DISTANCE} AS avg_distance
        FROM silver WHERE {_SLICED_DATES} AND {_SLICED_HOURS} GROUP BY PU_Borough""",
    "cube_weekdays": f"""
        SELECT * EXCLUDE (pickup_date, _layer), pickup_date AS day_of_week FROM ({CTES["daily"].replace(
            "FROM features GROUP BY pickup_date",
            f"FROM (SELECT * REPLACE ({DAY_OF_WEEK.format('pickup_date')} AS pickup_date) FROM features "
            f"WHERE {_SLICED_HOURS}) GROUP BY pickup_date")})""",
    "dq_changed_days": _changed_days(),
    "dq_layers_agree": "SELECT pickup_date, 0::BIGINT AS expected_rows, 0::BIGINT AS actual_rows, "
    "0::BIGINT AS missing, 0::BIGINT AS surplus FROM silver WHERE false",
    "interleaved_layout": "SELECT PULocationID AS zone, count(*) AS trips, true AS most_files_skipped, true AS days_skip_too "
    "FROM silver GROUP BY PULocationID",
}


def _with_ctes(sql: str) -> str:
    """Prefix a query with the expressions it needs, in order of dependency."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    ctes = ", ".join(f"{name} AS ({CTES[name].strip()})" for name in needed)
    return f"WITH {ctes} {sql.strip()}"


def _inventory() -> str:
    return " UNION ALL ".join(
        f"SELECT '{spec.layer}' AS layer, '{spec.name}' AS table_name, "
        f"'{','.join(spec.partition_by)}' AS partition_columns, count(*) AS record_count FROM {STORED[key]}"
        for key, spec in TABLES.items()
    )


# What does not differ from run to run: no record is lost, and the files are as they should be.
QUERIES |= {
    "file_layout": "SELECT count(*) AS record_count, true AS each_file_once FROM bronze",
    "table_inventory": _inventory(),
    "compact_table": "SELECT 'silver copy' AS table_name, 'SUCCESS' AS status, count(*) AS records_before, "
    "count(*) AS records_after, true AS fewer_files, true AS within_need, true AS settled FROM silver",
    "expired_files": "SELECT CAST(0 AS BIGINT) AS live_reported, count(*) > 0 AS all_old_reported FROM silver",
    "clustered_layout": "SELECT count(*) AS record_count, CAST(0 AS BIGINT) AS overlaps FROM silver",
}


def _type_drift() -> str:
    """(column, type and spelling in each of the three sources, common type)."""
    columns = {
        "trip_key": (("bigint", "bigint", "bigint"), "bigint", ()),
        "trip_distance": (("float", "double", "double"), "double", ()),
        "passenger_count": (("int", "bigint", "double"), "double", (2,)),
        "vendor": ((None, "string", "int"), "string", ()),
        "tip_amount": ((None, None, "double"), "double", ()),
    }
    stored_in = {"vendor": "trip_line"}
    rows = []
    for name, (kinds, common, respelled) in columns.items():
        for number, kind in enumerate(kinds, 1):
            low, high = q.DRIFT_YEARS[number - 1 : number + 1]
            own = None if kind is None else "Passenger_Count" if number in respelled else name
            change = "absent" if kind is None else "widened" if kind != common else "same"
            counted = "count(*) * 0" if kind is None else f"count({stored_in.get(name, name)})"
            shown = [f"'{x}'" if x else "CAST(NULL AS VARCHAR)" for x in (own, kind)]
            rows.append(
                f"SELECT 'yellow_tripdata_2023-0{number}.parquet' AS source, '{name}' AS column_name, {shown[0]} AS source_column, "
                f"{shown[1]} AS source_type, '{common}' AS common_type, '{change}' AS change, "
                f"CAST({counted} AS BIGINT) AS filled_rows "
                f"FROM lens WHERE year(tpep_pickup_datetime) BETWEEN {low} AND {high - 1}"
            )
    return " UNION ALL ".join(rows)


def _seasonal_forecast() -> str:
    """The fold over the days as a recursion, for all weights at once, then for the best."""

    def listed(numbers: tuple[float, ...]) -> str:
        return f"(SELECT unnest([{', '.join(map(str, numbers))}]::DOUBLE[]) AS {{}})"

    def fold(name: str, weights: str, level: str, end: str) -> str:
        place = "CAST(s.day % 7 AS BIGINT) + 1"
        return f"""
        {name} AS (
          SELECT a, b, c, first AS day, level, 0::DOUBLE AS trend, season, 0::DOUBLE AS errors
          FROM {weights}, {level}, span
          UNION ALL
          SELECT a, b, c, day + 1, level + trend + a * e, trend + b * e,
                 list_transform(season, lambda x, i: CASE WHEN i = place THEN x + c * e ELSE x END), errors + e * e
          FROM (SELECT s.*, {place} AS place, coalesce(y.value - (s.level + s.trend + s.season[{place}]), 0) AS e
                FROM {name} s JOIN series y ON y.day = s.day, span WHERE s.day < {end}) t
        )"""

    def start(name: str, until: str) -> str:
        return f"""
        {name} AS (
          SELECT any_value(l.level) AS level, list(coalesce(w.mean - l.level, 0) ORDER BY p) AS season
          FROM (SELECT unnest(range(7)) AS p) LEFT JOIN (
            SELECT day % 7 AS p, avg(value) AS mean FROM series, span
            WHERE day < least(first + 28, {until}) GROUP BY 1) w USING (p),
          (SELECT coalesce(avg(value), 0) AS level FROM series, span WHERE day < least(first + 28, {until})) l
        )"""

    ahead = "level + trend * {0} + season[CAST((day + {0} - 1) % 7 AS BIGINT) + 1]"
    value = ahead.format("days_ahead")
    return f"""
        WITH RECURSIVE span AS (
          SELECT min(d) AS first, max(d) AS last, greatest(max(d) + 1 - {forecast.HELD_OUT}, min(d) + 1) AS train_end
          FROM (SELECT {_UNIX_DAY.format('pickup_date')} AS d FROM daily)
        ), series AS (
          SELECT day, value FROM (SELECT unnest(range(first, last + 1)) AS day FROM span)
          LEFT JOIN (SELECT {_UNIX_DAY.format('pickup_date')} AS day, CAST(total_trips AS DOUBLE) AS value FROM daily) USING (day)
        ), grid AS (
          SELECT a, b, c FROM {listed(forecast.LEVELS).format('a')}, {listed(forecast.TRENDS).format('b')}, {listed(forecast.SEASONS).format('c')}
        ), {start('train_start', 'train_end')}, {start('full_start', 'last + 1')},
        {fold('tried', 'grid', 'train_start', 'span.train_end')},
        best AS (
          SELECT t.* FROM tried t, span WHERE t.day = train_end ORDER BY errors, a, b, c LIMIT 1
        ), missed AS (
          SELECT sqrt(avg(error * error)) AS rmse
          FROM (SELECT value - (level + trend * (y.day - b.day + 1) + season[CAST(y.day % 7 AS BIGINT) + 1]) AS error
                FROM best b JOIN series y ON y.day >= b.day)
        ), {fold('fitted', '(SELECT a, b, c FROM best)', 'full_start', 'span.last + 1')}
        SELECT CAST(DATE '1970-01-01' + CAST(day - 1 + days_ahead AS INTEGER) AS DATE) AS forecast_date,
               CAST(days_ahead AS INTEGER) AS days_ahead, {half_up(value, 2)} AS forecast_trips,
               {half_up(f'{value} - {forecast.BOUND} * rmse', 2)} AS lower_trips,
               {half_up(f'{value} + {forecast.BOUND} * rmse', 2)} AS upper_trips
        FROM (SELECT * FROM fitted, span WHERE day = last + 1), missed,
             (SELECT unnest(generate_series(1, {forecast.FORECAST_DAYS})) AS days_ahead)"""


def _corrected(sql: str) -> str:
    """A query over trips whose fares of one month are higher by one."""
    fare = f"CASE WHEN strftime(tpep_pickup_datetime, '%Y-%m') = '{q.CORRECTED_MONTH}' THEN fare_amount + 1 ELSE fare_amount END"
    return _with_ctes(sql).replace("FROM lens", f"FROM (SELECT * REPLACE ({fare} AS fare_amount) FROM lens)")


# Tables after a refresh are those of a full run over the corrected trips.
_REFRESHED = {"refreshed_daily": "daily", "refreshed_routes": "routes", "refreshed_monthly": "monthly"}


def _with_daily(sql: str) -> str:
    """A query that has expressions of its own, after those that make the daily table."""
    return f"WITH RECURSIVE {_with_ctes('SELECT * FROM daily')[5:].rpartition('SELECT * FROM daily')[0]}, {sql.strip()[15:]}"


QUERIES["bronze_type_drift"] = _type_drift()


def oracle_queries() -> dict[str, str]:
    refreshed = {name: _corrected(f"SELECT * FROM {table}") for name, table in _REFRESHED.items()}
    return {name: _with_ctes(sql) for name, sql in QUERIES.items()} | refreshed | {
        "mart_seasonal_forecast": _with_daily(_seasonal_forecast())
    }
