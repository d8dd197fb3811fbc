"""Finding where two versions of a table differ, from coarse to fine.

Rows are hashed, and hashes added up per month, day and row, in sums that do not depend on the
order of rows.  Each level is only computed inside what differs on the level above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import year_month

_HALF = (1 << 32) - 1


def row_digest(columns: list[str]) -> Column:
    """A 64-bit hash of a row in which nulls have a place of their own, and -0.0 and 0.0 are alike."""
    parts = []
    for name in sorted(columns):
        parts += [F.isnull(name), F.col(name)]
    return F.xxhash64(*parts)


def group_digests(df: DataFrame, keys: list[Column], columns: list[str]) -> DataFrame:
    """Rows, and the sums of both halves of their hashes, per group; sums stay exact for 2^31 rows and more."""
    hashed = df.withColumn("_hash", row_digest(columns))
    low = F.col("_hash").bitwiseAND(F.lit(_HALF))
    return hashed.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.sum(low).alias("low"),
        F.sum(F.shiftrightunsigned("_hash", 32)).alias("high"),
        F.bit_xor("_hash").alias("mixed"),
    )


def differing_groups(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose digests differ, with the rows of both sides (0 where a side has none)."""
    digest = ("rows", "low", "high", "mixed")
    left = expected.select(*keys, F.struct(*digest).alias("_expected"))
    right = actual.select(*[F.col(key).alias(f"_{key}") for key in keys], F.struct(*digest).alias("_actual"))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    both = left.join(right, same, "full").filter(~F.col("_expected").eqNullSafe(F.col("_actual")))
    there = F.col("_expected").isNotNull()
    return both.select(
        *[F.when(there, F.col(key)).otherwise(F.col(f"_{key}")).alias(key) for key in keys],
        F.coalesce("_expected.rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("_actual.rows", F.lit(0)).alias("actual_rows"),
    )


def differing_days(expected: DataFrame, actual: DataFrame, columns: list[str], day: str = "pickup_date") -> DataFrame:
    """Days on which two tables differ in some columns, with how many rows each has and lacks.

    First one digest per month is compared.  Only months that differ are read again, by day, and
    only the rows of days that differ are compared one with another: ``missing`` are rows of the
    expected table that the actual one lacks, ``surplus`` the other way round, repeated rows
    counted as often as they are repeated.  Equal tables give no row.  The months and days that
    differ reach the driver; the calendar bounds them.
    """
    month = [year_month(day).alias("_month")]
    frames = [df.select(*{day: 0, **dict.fromkeys(columns)}) for df in (expected, actual)]

    def differing(keys: list[Column], name: str) -> list:
        left, right = (group_digests(df, keys, columns) for df in frames)
        return [row[name] for row in differing_groups(left, right, [name]).collect()]

    def only(condition_of, values: list) -> None:
        known = [value for value in values if value is not None]
        wanted = condition_of().isin(known)
        if len(known) < len(values):
            wanted = F.coalesce(wanted, F.lit(True))
        frames[:] = [df.filter(wanted) for df in frames]

    months = differing(month, "_month")
    only(lambda: year_month(day), months)
    days = differing([F.col(day)], day) if months else []
    only(lambda: F.col(day), days)

    signed = [df.withColumn("_side", F.lit(side)) for df, side in zip(frames, (1, -1))]
    rows = signed[0].unionByName(signed[1]).withColumn("_digest", row_digest(columns))
    surplus = rows.groupBy(day, "_digest").agg(F.sum("_side").alias("_more"), F.count_if(F.col("_side") == 1).alias("_rows"))
    return surplus.groupBy(day).agg(
        F.sum("_rows").alias("expected_rows"),
        (F.sum("_rows") - F.sum("_more")).alias("actual_rows"),
        F.sum(F.greatest("_more", F.lit(0))).alias("missing"),
        F.sum(F.greatest(-F.col("_more"), F.lit(0))).alias("surplus"),
    )
