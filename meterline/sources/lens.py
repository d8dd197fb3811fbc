"""Trip-shaped view of the star-schema test tables.

The orders side (orders with the customer's nation) is joined first, so line
items are shuffled once by order key and once by supplier key at most; small
dimensions are broadcast by Catalyst from their measured size, and adaptive skew
handling splits a hot key.  Filters on line-item columns reach the line-item scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns read, with the types they are stored in.  Naming them
# saves the schema inference job of every table.
_STORED = {
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double"
    ),
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int",
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_STORED[name]).parquet(f"{folder}/{name}.parquet")


# The trip-shaped expressions over the joined tables.
_START = "(l_orderkey * 7919 + l_partkey * 31 + l_suppkey * 17) % 86400"
_LENGTH = "(l_partkey * 13 + l_suppkey * 97 + l_linenumber * 61) % 5400 - 60"
_DAY = "unix_micros(CAST(o_orderdate AS TIMESTAMP))"
_PRICE = "l_extendedprice * (1D - l_discount) / 1000D"
_TRIP = {
    "trip_key": "l_orderkey",
    "trip_line": "l_linenumber",
    "tpep_pickup_datetime": f"timestamp_micros({_DAY} + ({_START}) * 1000000)",
    "tpep_dropoff_datetime": f"timestamp_micros({_DAY} + ({_START} + {_LENGTH}) * 1000000)",
    "passenger_count": "IF(l_linenumber = 1 AND l_partkey % 11 = 0, NULL, CAST(l_linenumber AS DOUBLE))",
    "trip_distance": "l_quantity * 2.1D - 3D",
    "fare_amount": f"{_PRICE} - 2D",
    "total_amount": f"{_PRICE} * (1D + l_tax) - 1D",
    "tip_amount": "l_extendedprice * l_tax / 1000D",
    "PULocationID": "IF(l_partkey % 97 = 0, NULL, c_nationkey)",
    "DOLocationID": (
        "CASE WHEN l_suppkey % 53 = 0 THEN s_nationkey + 1000 WHEN l_partkey % 89 <> 0 THEN s_nationkey END"
    ),
}


def trips_from_star(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips: one per line item, with bad values of every kind the filters remove."""
    lines, orders, customers, suppliers = (
        read_star_table(spark, folder, name) for name in ("lineitem", "orders", "customer", "supplier")
    )
    placed = orders.join(customers, F.expr("o_custkey = c_custkey")).select(
        "o_orderkey", "o_orderdate", "c_nationkey"
    )
    joined = lines.join(placed, F.expr("l_orderkey = o_orderkey")).join(
        suppliers.select("s_suppkey", "s_nationkey"), F.expr("l_suppkey = s_suppkey")
    )
    return joined.selectExpr(*[f"{sql} AS {name}" for name, sql in _TRIP.items()])


def zones_from_star(spark: SparkSession, folder: str) -> DataFrame:
    """Zone lookup with untidy names: one zone per nation, the region as its borough."""
    nations = read_star_table(spark, folder, "nation")
    regions = read_star_table(spark, folder, "region")
    return nations.join(regions, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_nationkey AS LocationID", "concat('  ', lower(r_name), ' ') AS Borough", "concat(' ', n_name) AS Zone"
    )
