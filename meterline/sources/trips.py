"""Ingestion of monthly trip files and of the zone lookup."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.operators.stamps import stamp_bronze
from meterline.sources.drift import common_schema, conformed, drift_report
from meterline.sources.files import Storage

# Fixed value: how the published monthly files are named.
MONTHLY_PATTERN = "yellow_tripdata_2023-*.parquet"


def find_monthly_files(spark: SparkSession, folder: str, pattern: str = MONTHLY_PATTERN) -> list[str]:
    """Monthly files (or monthly folders of part files), sorted by name."""
    found = Storage(spark).matching(f"{folder.rstrip('/')}/{pattern}")
    if not found:
        raise FileNotFoundError(f"nothing matches {pattern} in {folder}")
    return found


def other_files(spark: SparkSession, folder: str, pattern: str = MONTHLY_PATTERN) -> list[str]:
    """Parquet files or folders beside the monthly ones that the pattern leaves out."""
    storage, folder = Storage(spark), folder.rstrip("/")
    return sorted({*storage.matching(f"{folder}/*.parquet")} - {*storage.matching(f"{folder}/{pattern}")})


def union_months(frames: list[DataFrame]) -> DataFrame:
    """Union by name: columns a month lacks are null, differing types become the least that holds all."""
    common = common_schema(frame.schema for frame in frames)
    return reduce(DataFrame.union, [conformed(frame, common) for frame in frames])


def month_schemas(spark: SparkSession, path: str) -> Iterator[tuple[StructType, str]]:
    """The schemas a month is to be read with, and what to read with each.

    The footers of all part files are merged, which Spark distributes, so a column that only
    some parts have is not lost.  Where that fails, each part is read with its own schema: types
    that conflict are no error there, and a part that cannot be read still is.
    """
    try:
        schemas = [(spark.read.option("mergeSchema", True).parquet(path).schema, path)]
    except (PySparkException, Py4JJavaError):
        parts = Storage(spark).data_files(path)
        if len(parts) < 2:
            raise
        schemas = [(spark.read.parquet(file).schema, file) for file in parts]
    yield from schemas


def read_months(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All months, each row with its source file.

    Months with the same schema share one scan, so the plan has a branch per
    schema rather than per file.
    """
    by_schema: dict[str, tuple] = {}
    for path in paths:
        for schema, part in month_schemas(spark, path):
            by_schema.setdefault(schema.json(), (schema, []))[1].append(part)
    return union_months(
        [
            spark.read.schema(schema).parquet(*members).withColumn("_source_file", F.col("_metadata.file_path"))
            for schema, members in by_schema.values()
        ]
    )


def month_drift(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Which columns of which months or parts differ from the type they are united to."""
    schemas = {part.rpartition("/")[2]: schema for path in paths for schema, part in month_schemas(spark, path)}
    return drift_report(spark, schemas)


def ingest_trips(spark: SparkSession, paths: list[str], run_date: dt.date) -> DataFrame:
    return stamp_bronze(read_months(spark, paths), run_date)


def ingest_zones(spark: SparkSession, path: str, run_date: dt.date) -> DataFrame:
    """Zone lookup from CSV with a header.

    Columns are taken from the header and read as text, without an inference pass
    over the data; only the key is converted.
    """
    raw = spark.read.option("header", True).csv(path)
    return stamp_bronze(raw.withColumn("LocationID", F.col("LocationID").try_cast("int")), run_date)
