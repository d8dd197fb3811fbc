"""Layer tags and run-time stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.layout import BRONZE, CLOCK_COLUMNS


def tag(df: DataFrame, layer: str, clock: str | None = None) -> DataFrame:
    """Add ``_layer`` and, when named, a column holding the time of the query."""
    stamps = {"_layer": F.lit(layer)}
    if clock:
        stamps[clock] = F.current_timestamp()
    return df.withColumns(stamps)


def stamp_bronze(df: DataFrame, run_date: dt.date) -> DataFrame:
    """Ingestion stamps; ``run_date`` is passed in so a re-run gives the same rows."""
    return tag(df, BRONZE, "_ingestion_timestamp").withColumn("_ingestion_date", F.lit(run_date))


def without_clock(df: DataFrame) -> DataFrame:
    return df.drop(*CLOCK_COLUMNS)
