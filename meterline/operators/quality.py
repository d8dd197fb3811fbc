"""Data-quality checks: any number of rules in one aggregate pass, one row per check."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import TIME_PERIODS
from meterline.functions.numeric import CENTS, MICROS, exact_mean
from meterline.operators.cleaning import TRIP_RULES

PASSED, WARNING, FAILED = "PASSED", "WARNING", "FAILED"

# Limits the checks compare against.
MAX_SPEED_MPH = 100
NULL_WARNING_PCT = 5.0
MIN_BOROUGHS = 5
CRITICAL_COLUMNS = ("tpep_pickup_datetime", "fare_amount", "trip_distance")


@dataclass(frozen=True)
class Check:
    """A condition on rows: how many rows meet it must be zero, or must not be."""

    name: str
    kind: str
    condition: str
    must_be_zero: bool = True


# The checks on cleaned trips.  A null does not violate a range check.
SILVER_CHECKS = (
    Check("data_exists", "volume", "true", must_be_zero=False),
    Check(
        "critical_columns_not_null",
        "completeness",
        " OR ".join(f"{name} IS NULL" for name in CRITICAL_COLUMNS),
    ),
    Check("fare_positive", "validity", "fare_amount <= 0"),
    Check("distance_positive", "validity", "trip_distance <= 0"),
    Check("passengers_valid", "validity", f"NOT ({TRIP_RULES['passengers_1_to_6']})"),
    Check("speed_reasonable", "validity", f"avg_speed_mph > {MAX_SPEED_MPH}"),
    Check("time_period_valid", "validity", f"time_period NOT IN {TIME_PERIODS}"),
    Check("pickup_before_dropoff", "consistency", f"NOT ({TRIP_RULES['pickup_before_dropoff']})"),
)


def rows_of(one_row: DataFrame, rows: Iterable[Iterable[str]], names: Iterable[str]) -> DataFrame:
    """Turn the single row of an aggregate into several, each given by SQL expressions."""
    rows = [", ".join(row) for row in rows]
    return one_row.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({', '.join(names)})")


def _check_counts(checks: Iterable[Check]) -> list[Column]:
    return [F.expr(f"count_if({check.condition}) AS {check.name}") for check in checks]


def run_checks(df: DataFrame, checks: Iterable[Check] = SILVER_CHECKS) -> DataFrame:
    checks = list(checks)
    return checks_of(df.agg(*_check_counts(checks)), checks)


def checks_of(counts: DataFrame, checks: Iterable[Check] = SILVER_CHECKS) -> DataFrame:
    """One row per check from the single row of their counts."""

    def row(check: Check) -> list[str]:
        test = "= 0" if check.must_be_zero else "> 0"
        return [
            f"'{check.name}'",
            f"'{check.kind}'",
            f"IF({check.name} {test}, '{PASSED}', '{FAILED}')",
            f"'{test}'",
            f"CAST({check.name} AS STRING)",
            "0D",
        ]

    return rows_of(
        counts,
        [row(check) for check in checks],
        ("check_name", "check_type", "status", "expected_value", "actual_value", "threshold"),
    )


def check_summary(results: DataFrame) -> DataFrame:
    """Tally of check rows with the failed names in order."""
    passed, failed = (f"count_if(status = '{status}')" for status in (PASSED, FAILED))
    failed_names = f"collect_list(IF(status = '{FAILED}', check_name, NULL))"
    return results.groupBy().agg(
        F.expr("count(*) AS checks_run"),
        F.expr(f"{passed} AS checks_passed"),
        F.expr(f"{failed} AS checks_failed"),
        F.expr(f"coalesce(round(try_divide({passed}, count(*)) * 100, 1), 0D) AS pass_rate"),
        F.expr(f"array_join(sort_array({failed_names}), ',') AS failed_checks"),
    )


STATISTICS = ("avg_distance", "min_distance", "max_distance", "avg_fare", "avg_speed")


def _statistics() -> list[Column]:
    columns = (
        exact_mean("trip_distance", MICROS),
        F.min("trip_distance"),
        F.max("trip_distance"),
        exact_mean("fare_amount", CENTS),
        exact_mean("avg_speed_mph", CENTS),
    )
    return [column.alias(name) for name, column in zip(STATISTICS, columns)]


def trip_statistics(silver: DataFrame) -> DataFrame:
    return silver.agg(*_statistics())


def measured(silver: DataFrame) -> DataFrame:
    """The counts of all checks and the statistics in one row, from one pass."""
    return silver.agg(*_check_counts(SILVER_CHECKS), *_statistics())


def statistics_of(measures: DataFrame) -> DataFrame:
    return measures.select(*STATISTICS)


def borough_distribution(silver: DataFrame) -> DataFrame:
    """Trips per pickup borough, largest first; trips without a borough form a group."""
    counts = silver.groupBy("PU_Borough").agg(F.count("*").alias("trips"))
    return counts.orderBy(F.desc("trips"), F.asc_nulls_first("PU_Borough"))


def null_profile(df: DataFrame, columns: Iterable[str], warn_pct: float = NULL_WARNING_PCT) -> DataFrame:
    """Null (for floating columns also NaN) count and share per column; an absent column is FAILED."""
    kinds, columns = dict(df.dtypes), list(columns)

    def missing(name: str) -> str:
        if name not in kinds:
            return "CAST(NULL AS BOOLEAN)"
        return f"{name} IS NULL" + (f" OR isnan({name})" if kinds[name] in ("double", "float") else "")

    counts = df.agg(
        F.expr("count(*) AS _rows"),
        *[F.expr(f"count_if({missing(name)}) AS {name}") for name in columns],
    )

    def row(name: str) -> list[str]:
        if name not in kinds:
            return [f"'{name}'", "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", f"'{FAILED}'"]
        share = f"coalesce(round(try_divide({name}, _rows) * 100, 4), 0D)"
        return [f"'{name}'", name, share, f"IF({share} > {warn_pct}, '{WARNING}', '{PASSED}')"]

    names = ("column_name", "null_count", "null_pct", "status")
    return rows_of(counts, [row(name) for name in columns], names)


def required_columns(tables: Mapping[str, tuple[DataFrame, Iterable[str]]]) -> DataFrame:
    """Whether each table has each required column, and how many rows fill it."""
    parts = []
    for table, (df, columns) in tables.items():
        filled = {name: f"count({name})" if name in df.columns else "0L" for name in columns}
        counts = df.agg(F.expr("count(*) AS _rows"), *[F.expr(f"{n} AS {name}") for name, n in filled.items()])
        rows = [
            [f"'{table}'", f"'{name}'", name, f"'{PASSED if name in df.columns else FAILED}'"]
            for name in filled
        ]
        parts.append(rows_of(counts, rows, ("table_name", "column_name", "filled_rows", "status")))
    return reduce(DataFrame.unionByName, parts)


def zone_boroughs(zones: DataFrame, minimum: int = MIN_BOROUGHS) -> DataFrame:
    """Zones per borough with the number of distinct boroughs (null is one of them)."""
    per_borough = zones.groupBy(F.col("Borough").alias("borough")).agg(F.count("*").alias("zones"))
    return per_borough.selectExpr(
        "borough",
        "zones",
        "count(*) OVER () AS borough_count",
        f"IF(count(*) OVER () >= {minimum}, '{PASSED}', '{WARNING}') AS status",
    )
