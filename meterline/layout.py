"""The stored tables: layer, name, partitioning and expected minimum size."""

from __future__ import annotations

from dataclasses import dataclass

BRONZE, SILVER, GOLD, ANALYTICS = "bronze", "silver", "gold", "analytics"
LAYERS = (BRONZE, SILVER, GOLD, ANALYTICS)


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    description: str
    min_records: int = 0
    partition_by: tuple[str, ...] = ()
    tagged: bool = False  # carries a ``_layer`` column
    few_per_partition: bool = False  # an aggregate with a handful of rows per partition value

    @property
    def key(self) -> str:
        return f"{self.layer}.{self.name}"


# Table names, partition columns and minimum row counts.
TABLES = {
    spec.key: spec
    for spec in (
        TableSpec(BRONZE, "trips", "raw trips", 10_000_000, (), True),
        TableSpec(BRONZE, "taxi_zone_lookup", "zone lookup", 200, (), True),
        TableSpec(SILVER, "trips_cleaned", "cleaned trips", 8_000_000, ("pickup_date",), True),
        TableSpec(GOLD, "trips_daily_metrics", "metrics per day", 10, (), True),
        TableSpec(GOLD, "trips_hourly_metrics", "metrics per hour", 100, ("pickup_date",), True, True),
        TableSpec(GOLD, "trips_borough_metrics", "metrics per borough", 20, ("pickup_date",), True, True),
        TableSpec(GOLD, "trips_popular_routes", "metrics per route", 100, (), True),
        TableSpec(ANALYTICS, "kpi_dashboard", "monthly KPIs", 5),
        TableSpec(ANALYTICS, "time_series_trends", "daily trends", 10),
        TableSpec(ANALYTICS, "hourly_heatmap", "weekday by hour", 100),
        TableSpec(ANALYTICS, "top_routes_analysis", "routes by volume", 20, (), True),
        TableSpec(ANALYTICS, "kpi_global", "headline KPIs", 1),
    )
}

# Columns a usable source must have.
REQUIRED_TRIP_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "PULocationID",
    "DOLocationID",
)
REQUIRED_ZONE_COLUMNS = ("LocationID", "Borough", "Zone")
BRONZE_STAMPS = ("_source_file", "_ingestion_timestamp", "_ingestion_date", "_layer")

# Columns whose value is the wall clock of the run.
CLOCK_COLUMNS = ("_ingestion_timestamp", "_transformation_timestamp", "_aggregation_timestamp")
