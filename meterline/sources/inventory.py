"""What is stored: files, sizes, tables, and files nothing refers to any more.

Everything about files comes from listings, which open no file and also show files without
rows.  Paths are compared in the form that the scan metadata gives them on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.layout import TABLES
from meterline.sources.files import Storage
from meterline.sources.lake import Lake, data_pattern

_FILES = "file_path string, size_bytes long, modified timestamp"
_INVENTORY = (
    "layer string, schema_name string, table_name string, location string, format string, partition_columns string, "
    "column_count int, record_count long, file_count long, size_bytes long, last_updated timestamp, description string"
)


def stored_files(spark: SparkSession, roots: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """Every data file below the given folders; folders that do not exist hold none."""
    storage = Storage(spark)
    present = [root for root in ([roots] if isinstance(roots, str) else roots) if storage.exists(root)]
    if not present:
        return spark.createDataFrame([], _FILES)
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(present)
    )
    meta = F.col("_metadata")
    return listing.select(
        meta["file_path"].alias("file_path"),
        meta["file_size"].alias("size_bytes"),
        meta["file_modification_time"].alias("modified"),
    )


def file_layout(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """One row per data file of a table with the records it holds, also when that is none."""
    rows = spark.read.format(fmt).load(location)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("record_count"))
    files = stored_files(spark, location, data_pattern(fmt))
    return files.join(counts, "file_path", "left").withColumn("record_count", F.coalesce("record_count", F.lit(0)))


def folder_layout(spark: SparkSession, location: str, target_bytes: int, fmt: str = "parquet") -> DataFrame:
    """Files and bytes per folder of a table, and the files it would need at the target size.

    A file cannot span two partition folders, so the need is counted per folder.  ``small`` are
    the files below half the target: any two of them fit into one.
    """
    folder = F.regexp_extract("file_path", "^(.*)/[^/]+$", 1)
    folders = stored_files(spark, location, data_pattern(fmt)).groupBy(folder.alias("folder")).agg(
        F.count("*").alias("files"),
        F.count_if(F.col("size_bytes") < target_bytes / 2).alias("small"),
        F.sum("size_bytes").alias("bytes"),
        F.max("modified").alias("modified"),
    )
    needed = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)).cast("long")
    return folders.withColumn("needed", needed)


def layout_summary(spark: SparkSession, location: str, target_bytes: int, fmt: str = "parquet") -> DataFrame:
    """One row: records, files, bytes, and the files a compacted table would need."""
    # a count without columns reads file footers only
    records = spark.read.format(fmt).load(location).count()
    return folder_layout(spark, location, target_bytes, fmt).agg(
        F.lit(records).cast("long").alias("record_count"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("file_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
        F.coalesce(F.sum("needed"), F.lit(0)).alias("files_needed"),
        F.max("modified").alias("last_updated"),
    )


def table_inventory(spark: SparkSession, lake: Lake, keys: Mapping[str, object] | None = None) -> DataFrame:
    """One row per stored table with its location, format, partitioning and volume."""
    parts = []
    for key in keys or TABLES:
        table = lake.find(spark, key)
        if table is None:
            continue
        spec = TABLES[key]
        parts.append(
            layout_summary(spark, lake.location(key), 1, lake.fmt).select(
                F.lit(spec.layer).alias("layer"),
                F.lit(lake.schema_name).alias("schema_name"),
                F.lit(spec.name).alias("table_name"),
                F.lit(lake.location(key)).alias("location"),
                F.lit(lake.fmt).alias("format"),
                F.lit(",".join(spec.partition_by)).alias("partition_columns"),
                F.lit(len(table.columns)).alias("column_count"),
                "record_count",
                "file_count",
                "size_bytes",
                "last_updated",
                F.lit(spec.description).alias("description"),
            )
        )
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], _INVENTORY))


def expired_files(
    spark: SparkSession, roots: str | list[str], live: list[str], cutoff: dt.datetime, fmt: str = "parquet"
) -> DataFrame:
    """Files below ``roots`` that lie in no live table and are older than the cutoff.

    ``live`` are the locations of the tables.  Reports candidates; removing them is left to
    the operator of the storage.
    """
    old = stored_files(spark, roots, data_pattern(fmt)).filter(F.col("modified") < F.lit(cutoff))
    return old.join(stored_files(spark, live, data_pattern(fmt)), "file_path", "left_anti")
