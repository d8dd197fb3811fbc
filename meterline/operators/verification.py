"""Checks across the stored layers: volumes, tags, nulls, totals, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.numeric import CENTS, exact_sum
from meterline.layout import TABLES
from meterline.operators.cleaning import clean_trips, typed_trips
from meterline.operators.quality import FAILED, PASSED, WARNING, rows_of

# Columns that must be filled in silver, and the factor for gold totals.
SILVER_FILLED = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount")
TOTALS_FACTOR = 1000

# A table that is not there is None.
Tables = Mapping[str, DataFrame | None]
CHECKS = "table_name string, check_name string, record_count long, status string"


def _missing(tables: Tables) -> list[str]:
    return [key for key, df in tables.items() if df is None]


def _session(tables: Tables) -> SparkSession:
    return next((df.sparkSession for df in tables.values() if df is not None), None) or SparkSession.active()


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _status(condition: str, otherwise: str) -> str:
    return f"IF({condition}, '{PASSED}', '{otherwise}') AS status"


def row_counts(tables: Tables) -> DataFrame:
    """Rows of each table; null for a table that is not there."""
    absent = [(key, None) for key in _missing(tables)]
    return _stack(
        [_session(tables).createDataFrame(absent, "table_name string, record_count long")] * bool(absent)
        + [
            df.agg(F.count("*").alias("record_count")).selectExpr(f"'{key}' AS table_name", "record_count")
            for key, df in tables.items()
            if df is not None
        ]
    )


def minimum_records(tables: Tables, thresholds: Mapping[str, int] | None = None) -> DataFrame:
    """Row count of each table against its expected minimum; a table that is not there is FAILED."""
    limits = {key: (thresholds or {}).get(key, TABLES[key].min_records) for key in tables}
    absent = [(key, TABLES[key].layer, None, limits[key], FAILED) for key in _missing(tables)]
    schema = "table_name string, layer string, record_count long, min_records long, status string"
    return _stack(
        [_session(tables).createDataFrame(absent, schema)] * bool(absent)
        + [
            df.agg(F.count("*").alias("record_count")).selectExpr(
                f"'{key}' AS table_name",
                f"'{TABLES[key].layer}' AS layer",
                "record_count",
                f"{limits[key]}L AS min_records",
                _status(f"record_count >= {limits[key]}", WARNING),
            )
            for key, df in tables.items()
            if df is not None
        ]
    )


def layer_values(tables: Tables) -> DataFrame:
    """Rows per ``_layer`` value of every tagged table, and whether the value belongs there.

    A table without the column has null as its only value.
    """
    with_tag = {
        key: df if "_layer" in df.columns else df.withColumn("_layer", F.lit(None).cast("string"))
        for key, df in tables.items()
        if df is not None
    }
    return _stack(
        [
            df.groupBy("_layer")
            .agg(F.count("*").alias("record_count"))
            .selectExpr(
                f"'{key}' AS table_name",
                "_layer AS layer_value",
                "record_count",
                _status(f"_layer <=> '{TABLES[key].layer}'", FAILED),
            )
            for key, df in with_tag.items()
        ]
    )


def silver_nulls(silver: DataFrame) -> DataFrame:
    """Nulls per column that must be filled; an absent column has no count and is FAILED."""
    present = set(silver.columns)
    counted = {
        name: f"count_if({name} IS NULL)" if name in present else "CAST(NULL AS BIGINT)" for name in SILVER_FILLED
    }
    counts = silver.agg(*[F.expr(f"{count} AS {name}") for name, count in counted.items()])
    verdict = "CASE WHEN {0} IS NULL THEN '%s' WHEN {0} = 0 THEN '%s' ELSE '%s' END" % (FAILED, PASSED, WARNING)
    return rows_of(
        counts,
        [[f"'{name}'", name, verdict.format(name)] for name in SILVER_FILLED],
        ("column_name", "null_count", "status"),
    )


def gold_sanity(daily: DataFrame, min_records: int | None = None) -> DataFrame:
    """Total trips and revenue against a multiple of the expected number of days."""
    days = TABLES["gold.trips_daily_metrics"].min_records if min_records is None else min_records
    least = days * TOTALS_FACTOR
    absent = {"total_trips": "bigint", "total_revenue": "double"}
    daily = daily.withColumns({n: F.lit(None).cast(k) for n, k in absent.items() if n not in daily.columns})
    totals = daily.agg(
        F.sum("total_trips").alias("total_trips"),
        exact_sum("total_revenue", CENTS, 2).alias("total_revenue"),
    )
    return totals.selectExpr(
        "total_trips",
        "total_revenue",
        f"{least}L AS minimum",
        _status(f"total_trips >= {least} AND total_revenue >= {least}", WARNING),
    )


def table_checks(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per table and check; a table that could not be read is FAILED."""
    readable = {key: df for key, df in tables.items() if df is not None}
    tagged = {key: df for key, df in readable.items() if TABLES[key].tagged}

    def part(df: DataFrame, table: str, check: str, records: str, status: str) -> DataFrame:
        return df.selectExpr(
            f"{table} AS table_name", f"'{check}' AS check_name", f"{records} AS record_count", status
        )

    parts = []
    if readable:
        parts.append(part(minimum_records(readable), "table_name", "minimum_records", "record_count", "status"))
    if tagged:
        # membership: the check passes as long as the layer's own value occurs
        found = layer_values(tagged).groupBy("table_name").agg(F.expr(f"count_if(status = '{PASSED}') AS n"))
        parts.append(part(found, "table_name", "layer_tag", "0L", _status("n > 0", WARNING)))
    for key, check, build in (
        ("silver.trips_cleaned", "no_nulls", silver_nulls),
        ("gold.trips_daily_metrics", "totals", gold_sanity),
    ):
        if key in readable:
            bad = build(readable[key]).agg(F.expr(f"count_if(status <> '{PASSED}') AS n"))
            parts.append(part(bad, f"'{key}'", check, "0L", _status("n = 0", WARNING)))
    missing = [(key, "readable", 0, FAILED) for key, df in tables.items() if df is None]
    if missing:
        parts.append(_session(tables).createDataFrame(missing, CHECKS))
    return _stack(parts)


# Worst of the statuses in a group.
_WORST = (
    f"CASE WHEN count_if(status = '{FAILED}') > 0 THEN '{FAILED}' "
    f"WHEN count_if(status = '{WARNING}') > 0 THEN '{WARNING}' ELSE '{PASSED}' END"
)


def table_status(checks: DataFrame) -> DataFrame:
    """Worst status per table."""
    return checks.groupBy("table_name").agg(
        F.sum("record_count").alias("record_count"), F.expr(f"{_WORST} AS status")
    )


def layer_status(checks: DataFrame) -> DataFrame:
    """Tables per status and verdict per layer."""
    layer = F.expr("substring_index(table_name, '.', 1) AS layer")
    return (
        table_status(checks)
        .groupBy(layer)
        .agg(
            F.expr("count(*) AS tables"),
            F.expr(f"count_if(status = '{PASSED}') AS passed"),
            F.expr(f"count_if(status = '{WARNING}') AS warnings"),
            F.expr(f"count_if(status = '{FAILED}') AS failed"),
            F.expr("sum(record_count) AS records"),
            F.expr(f"IF(count_if(status <> '{PASSED}') = 0, '{PASSED}', 'ISSUES FOUND') AS verdict"),
        )
    )


def overall_status(checks: DataFrame) -> DataFrame:
    """The verdict on the run: FAILED only when a table could not be read."""
    return table_status(checks).agg(
        F.expr("count(*) AS tables"),
        F.expr(f"round(count_if(status = '{PASSED}') / count(*) * 100, 1) AS pass_rate"),
        F.expr("sum(record_count) AS records"),
        F.expr(f"{_WORST} AS verdict"),
    )


def reconcile(tables: Tables) -> DataFrame:
    """Trip counts that must agree between layers, expected against actual.

    A table that is not there has null as its count, which agrees with nothing.
    """
    spark = _session(tables)

    def unknown(*names: str) -> DataFrame:
        return spark.range(1).select(*[F.lit(None).cast("long").alias(name) for name in names])

    silver, bronze = tables.get("silver.trips_cleaned"), tables.get("bronze.trips")
    if silver is None:
        silver = unknown("silver", "with_borough", "with_zones")
    else:
        silver = silver.agg(
            F.expr("count(*) AS silver"),
            F.expr("count(PU_Borough) AS with_borough"),
            F.expr("count_if(PU_Zone IS NOT NULL AND DO_Zone IS NOT NULL) AS with_zones"),
        )
    if bronze is None:
        accepted = unknown("actual")
    else:
        accepted = clean_trips(typed_trips(bronze)).agg(F.expr("count(*) AS actual"))

    def trips(name: str) -> DataFrame:
        gold = tables.get(f"gold.{name}")
        return unknown("actual") if gold is None else gold.agg(F.expr("coalesce(sum(total_trips), 0) AS actual"))

    pairs = {
        "silver_keeps_accepted": ("silver", accepted),
        "daily_covers_silver": ("silver", trips("trips_daily_metrics")),
        "hourly_covers_silver": ("silver", trips("trips_hourly_metrics")),
        "borough_covers_known": ("with_borough", trips("trips_borough_metrics")),
        "routes_cover_known": ("with_zones", trips("trips_popular_routes")),
    }
    rows = [[f"'{name}'", expected] for name, (expected, _) in pairs.items()]
    expected = rows_of(silver, rows, ("check_name", "expected"))
    actual = _stack(
        [df.selectExpr(f"'{name}' AS check_name", "actual") for name, (_, df) in pairs.items()]
    )
    return expected.join(actual, "check_name").selectExpr(
        "check_name", "expected", "actual", _status("expected = actual", FAILED)
    )
