"""Every operator as a named query over a folder of star-schema test tables.

Single-table operators are lazy plans from the raw tables.  Queries about stored
tables (layout, maintenance, checks across layers) run over layers written once per
application and input folder into the shared folder of the session.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.layout import REQUIRED_TRIP_COLUMNS, TABLES
from meterline.operators import cube, kpis, marts, quality, rollups, routes, verification
from meterline.operators.cleaning import clean_trips, filter_audit, typed_trips
from meterline.operators.digests import differing_days
from meterline.operators.enrichment import checked_zones, silver_trips, tidy_zones
from meterline.operators.features import trip_features
from meterline.operators.forecast import seasonal_forecast
from meterline.operators.stamps import stamp_bronze, without_clock
from meterline.plans import maintenance
from meterline.plans.pipeline import Pipeline, analytics_results, stored_tables, verify_bronze
from meterline.session import pin_session, shared_folder
from meterline.sources.exports import export_check
from meterline.sources.files import Storage
from meterline.sources.inventory import (
    expired_files,
    file_layout,
    folder_layout,
    layout_summary,
    stored_files,
    table_inventory,
)
from meterline.sources.lake import Lake, refresh_partitions, write_table
from meterline.sources.lens import trips_from_star, zones_from_star
from meterline.sources.trips import find_monthly_files, month_drift, read_months, union_months

Query = Callable[[SparkSession, str], DataFrame]

# The run date stamped on test data, and the slices used by the parameterised marts.
RUN_DATE = dt.date(2024, 1, 1)
SLICE_DATES = (dt.date(1996, 1, 1), dt.date(1999, 12, 31))
SLICE_HOURS = (6, 20)
SLICE_WEEKDAYS = ("Monday", "Wednesday", "Saturday")
SLICE_BOROUGHS = ("ASIA", "EUROPE")
SCHEMA_CHANGE = dt.datetime(1998, 1, 1)
CORRECTED_MONTH = "1997-03"
# Layout trials copy silver into about this many files of at most the target size, and
# fragment such a copy into this many times the files beforehand.
COPY_FILES = 4
DRIFT_YEARS = (1995, 1997, 1999, 2003)
CLUSTER_FILES = 32
# Pickup zones whose trips a copy of silver changes and lacks.
CHANGED_ZONE, LOST_ZONE = 7, 11
FRAGMENTS = 6


class Layers:
    """Lazy layers over one input folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_session(spark)
        self.folder = folder

    def raw_trips(self) -> DataFrame:
        return trips_from_star(self.spark, self.folder)

    def raw_zones(self) -> DataFrame:
        return zones_from_star(self.spark, self.folder)

    def bronze(self) -> DataFrame:
        return stamp_bronze(self.raw_trips(), RUN_DATE)

    def typed(self) -> DataFrame:
        return typed_trips(self.bronze())

    def features(self) -> DataFrame:
        return trip_features(clean_trips(self.typed()))

    def silver(self) -> DataFrame:
        return silver_trips(self.features(), checked_zones(self.raw_zones()))

    # Days and hours need no zone names, so their plans leave the zone joins out.
    def daily(self) -> DataFrame:
        return rollups.daily_metrics(self.features())

    def hourly(self) -> DataFrame:
        return rollups.hourly_metrics(self.features())

    def borough(self) -> DataFrame:
        return rollups.borough_metrics(self.silver())

    def routes(self) -> DataFrame:
        return rollups.route_metrics(self.silver())

    def trends(self) -> DataFrame:
        return kpis.daily_trends(self.daily())

    def monthly(self) -> DataFrame:
        return kpis.monthly_kpis(self.daily())


def _registered(build: Callable[[Layers], DataFrame]) -> Query:
    """Adapt a builder; clock columns are dropped and instants shown without a zone."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = without_clock(build(Layers(spark, folder)))
        instants = [name for name, kind in df.dtypes if kind == "timestamp"]
        return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})

    return query


def _drifting_months(layers: Layers) -> str:
    """Three sources written from the trips, whose columns differ in type, spelling and number."""
    folder = f"{shared_folder(layers.spark)}/drift-{time.time_ns()}"
    trips = layers.raw_trips()
    for number, (low, high) in enumerate(zip(DRIFT_YEARS, DRIFT_YEARS[1:]), 1):
        part = trips.filter(F.year("tpep_pickup_datetime").between(low, high - 1))
        distance, passengers = F.col("trip_distance"), F.col("passenger_count")
        columns = {
            1: [distance.cast("float").alias("trip_distance"), passengers.cast("int").alias("passenger_count")],
            2: [distance, passengers.cast("bigint").alias("Passenger_Count"), F.col("trip_line").cast("string").alias("vendor")],
            3: [distance, passengers.alias("passenger_count"), F.col("trip_line").alias("vendor"), F.col("tip_amount")],
        }[number]
        part.select("trip_key", *columns).write.parquet(f"{folder}/yellow_tripdata_2023-0{number}.parquet")
    return folder


def _type_drift(layers: Layers) -> DataFrame:
    """Per column and source its type, the common one, and the values that are there after the union."""
    spark = layers.spark
    paths = find_monthly_files(spark, _drifting_months(layers))
    months = read_months(spark, paths)
    names = [name for name in months.columns if not name.startswith("_")]
    source = F.regexp_extract("_source_file", "(yellow_tripdata[^/]*)", 1).alias("source")
    counts = months.groupBy(source).agg(*[F.count(name).alias(name) for name in names])
    values = counts.unpivot("source", names, "column_name", "filled_rows")
    return month_drift(spark, paths).join(values, ["source", "column_name"], "left").na.fill(0, ["filled_rows"])


def _schema_drift(layers: Layers) -> DataFrame:
    """Two sources whose schemas differ in type, letter case and columns, united by name."""
    trips = layers.raw_trips()
    early = F.col("tpep_pickup_datetime") < F.lit(SCHEMA_CHANGE)
    fee = F.when(F.col("PULocationID") % 5 == 0, 1.25).otherwise(0.0)
    before = trips.filter(early).select(
        "trip_key", "trip_line", "trip_distance", "passenger_count", fee.alias("Airport_fee")
    )
    after = trips.filter(~early).select(
        "trip_key",
        "trip_line",
        "trip_distance",
        F.col("passenger_count").cast("long").alias("passenger_count"),
        fee.alias("airport_fee"),
        F.col("tip_amount").alias("extra"),
    )
    return union_months([before, after])


# stored layers -----------------------------------------------------------------

_stored: dict[tuple[str, str], tuple[Lake, dict[str, DataFrame]]] = {}


def _store(layers: Layers) -> tuple[Lake, dict[str, DataFrame]]:
    """The layers of an input folder, written by the pipeline on first use, and their tables."""
    spark = layers.spark
    key = (spark.sparkContext.applicationId, layers.folder)
    if key not in _stored:
        name = hashlib.sha256("|".join(key).encode()).hexdigest()[:16]
        lake = Lake(f"{shared_folder(spark)}/layers-{name}")
        source = layers.bronze().withColumn("_source_file", F.lit(layers.folder))
        zones = stamp_bronze(layers.raw_zones(), RUN_DATE)
        job = Pipeline(spark, lake, source, zones, export_root=f"{lake.root}/exports")
        for stage in (job.bronze, job.silver, job.gold, job.analytics):
            stage()
        _stored[key] = lake, stored_tables(spark, lake)
    return _stored[key]


def stored_lake(layers: Layers) -> Lake:
    return _store(layers)[0]


def _stored_tables(layers: Layers) -> dict[str, DataFrame]:
    return _store(layers)[1]


def _tagged_tables(layers: Layers) -> dict[str, DataFrame]:
    return {key: df for key, df in _stored_tables(layers).items() if TABLES[key].tagged}


def _stored_table(layers: Layers, key: str) -> DataFrame:
    return _stored_tables(layers)[key]


def _scratch(layers: Layers, name: str) -> str:
    return f"{stored_lake(layers).root}/trials/{name}"


def _required_columns(layers: Layers) -> DataFrame:
    return verify_bronze(layers.spark, stored_lake(layers))["columns"]


def _exports(layers: Layers) -> DataFrame:
    lake = stored_lake(layers)
    results = analytics_results(layers.spark, lake)
    return union_months(
        [
            export_check(layers.spark, name, f"{lake.root}/exports/{name}", frame)
            for name, frame in results.items()
        ]
    )


def _silver_bytes(layers: Layers) -> int:
    lake = stored_lake(layers)
    folders = folder_layout(layers.spark, lake.location("silver.trips_cleaned"), 1)
    return max(folders.agg(F.sum("bytes")).first()[0] or 0, 1)


def _small_files(layers: Layers, name: str) -> tuple[str, int]:
    """A copy of silver in many times the files that it needs at the target size, which is returned too."""
    location, size = _scratch(layers, name), _silver_bytes(layers)
    target = min(maintenance.TARGET_BYTES, -(-size // COPY_FILES))
    silver = _stored_table(layers, "silver.trips_cleaned")
    # each task takes some of the stored files and writes one, so no row is shuffled
    with maintenance.packed_to(layers.spark, -(-target // FRAGMENTS)):
        silver.write.mode("overwrite").parquet(location)
    return location, target


def _file_layout(layers: Layers) -> DataFrame:
    """Records in all files of bronze, and whether each file is listed once."""
    location = stored_lake(layers).location("bronze.trips")
    return file_layout(layers.spark, location).agg(
        F.sum("record_count").alias("record_count"),
        (F.count("*") == F.count_distinct("file_path")).alias("each_file_once"),
    )


def _table_inventory(layers: Layers) -> DataFrame:
    """What the inventory says about each table that does not differ from run to run."""
    inventory = table_inventory(layers.spark, stored_lake(layers))
    return inventory.select("layer", "table_name", "partition_columns", "record_count")


def _compaction(layers: Layers) -> DataFrame:
    """A fragmented copy of silver, compacted: records before and after, and whether the files suffice."""
    location, target = _small_files(layers, "compaction")
    report = maintenance.compact_table(layers.spark, "silver copy", location, target_bytes=target)
    after = layout_summary(layers.spark, location, target).first()
    again = maintenance.compact_table(layers.spark, "silver copy", location, target_bytes=target)
    return maintenance.reports_frame(layers.spark, [report]).select(
        "table_name",
        "status",
        F.col("record_count").alias("records_before"),
        F.lit(after["record_count"]).cast("long").alias("records_after"),
        (F.col("files_after") < F.col("files_before")).alias("fewer_files"),
        F.lit(after["file_count"] <= 1.5 * after["files_needed"]).alias("within_need"),
        F.lit(again.message == "already compact").alias("settled"),
    )


def _expired(layers: Layers) -> DataFrame:
    """Files of a table before its compaction: none that is live is reported, and all others are."""
    location, target = _small_files(layers, "expiry/table")
    report = maintenance.compact_table(layers.spark, "silver copy", location, target_bytes=target)
    cutoff = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    found = expired_files(layers.spark, _scratch(layers, "expiry"), [location], cutoff)
    live = stored_files(layers.spark, location)
    return found.join(live.select("file_path", F.lit(1).alias("_live")), "file_path", "left").agg(
        F.count("_live").alias("live_reported"),
        (F.count("*") - F.count("_live") == report.files_before).alias("all_old_reported"),
    )


def _clustered(layers: Layers) -> DataFrame:
    """A clustered copy of silver: its records, and how many files overlap the next in their keys."""
    location, size = _scratch(layers, "clustered"), _silver_bytes(layers)
    target = min(maintenance.SORTED_BYTES, -(-size // COPY_FILES))
    silver = _stored_table(layers, "silver.trips_cleaned")
    maintenance.write_clustered(silver, location, files=-(-size // target))
    copy = layers.spark.read.parquet(location)
    key = F.struct("pickup_date", "PULocationID")
    files = copy.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("records"), F.min(key).alias("least"), F.max(key).alias("most")
    )
    # one row per file
    following = F.lead("least").over(Window.orderBy("least", "most"))
    return files.withColumn("_next", following).agg(
        F.sum("records").alias("record_count"), F.count_if(F.col("most") > F.col("_next")).alias("overlaps")
    )


def _cube(layers: Layers) -> DataFrame:
    return layers.spark.read.parquet(stored_lake(layers).side_table("cube"))


def _cube_hours(layers: Layers) -> DataFrame:
    """Hours of the day over all dates, for some weekdays and boroughs."""
    return cube.cube_slice(
        _cube(layers), (cube.HOUR,), rollups.HOURLY, weekdays=SLICE_WEEKDAYS, boroughs=SLICE_BOROUGHS
    )


def _cube_boroughs(layers: Layers) -> DataFrame:
    """Boroughs, with trips of none, for some dates and hours."""
    return cube.cube_slice(_cube(layers), (cube.BOROUGH,), rollups.BOROUGH, dates=SLICE_DATES, hours=SLICE_HOURS)


def _cube_weekdays(layers: Layers) -> DataFrame:
    """Weekdays for some hours, from a set without days."""
    return cube.cube_slice(_cube(layers), (cube.WEEKDAY,), rollups.DAILY, hours=SLICE_HOURS)


def _changed_days(layers: Layers) -> DataFrame:
    """Days on which a copy of silver differs whose fares of one pickup zone were changed in a month,
    and that lacks another zone's trips of a weekday."""
    silver = _stored_table(layers, "silver.trips_cleaned")
    month = F.date_format("pickup_date", "yyyy-MM") == CORRECTED_MONTH
    fare = F.when(month & (F.col("PULocationID") == CHANGED_ZONE), F.col("fare_amount") + 0.01).otherwise(F.col("fare_amount"))
    lost = month & (F.col("PULocationID") == LOST_ZONE) & (F.dayofweek("pickup_date") == 2)
    copy = silver.withColumn("fare_amount", fare).filter(~lost)
    return differing_days(silver, copy, [name for name in silver.columns if not name.startswith("_")])


def _layers_agree(layers: Layers) -> DataFrame:
    """Days on which stored silver differs from what bronze gives now: none."""
    silver = _stored_table(layers, "silver.trips_cleaned")
    return differing_days(layers.silver(), silver, [name for name in silver.columns if not name.startswith("_")])


def _interleaved(layers: Layers) -> DataFrame:
    """Trips per pickup zone, counted in only those files of a clustered copy that admit the zone,
    and whether these and the files that admit one day are a minor part."""
    spark, location, size = layers.spark, _scratch(layers, "interleaved"), _silver_bytes(layers)
    number = max(CLUSTER_FILES, -(-size // maintenance.SORTED_BYTES))
    silver = _stored_table(layers, "silver.trips_cleaned")
    maintenance.write_interleaved(silver, f"{location}/{size}-{time.time_ns()}", number)
    (copy,) = Storage(spark).matching(f"{location}/{size}-*")[-1:]
    rows = spark.read.parquet(copy).withColumn("_file", F.col("_metadata.file_path"))
    bounds = rows.groupBy("_file").agg(
        F.min("PULocationID").alias("least"), F.max("PULocationID").alias("most"),
        F.min("pickup_date").alias("first"), F.max("pickup_date").alias("last"),
    )
    zones = rows.select(F.col("PULocationID").alias("zone")).distinct()
    admitting = zones.join(bounds, F.col("zone").between(F.col("least"), F.col("most")))
    found = admitting.join(rows.select("_file", "PULocationID"), "_file").filter("PULocationID = zone")
    files = admitting.groupBy("zone").agg(F.count("*").alias("files"))
    days = rows.select("pickup_date").distinct().join(bounds, F.col("pickup_date").between(F.col("first"), F.col("last")))
    widest = days.groupBy("pickup_date").agg(F.count("*").alias("n")).agg(F.max("n").alias("widest"))
    return (
        found.groupBy("zone")
        .agg(F.count("*").alias("trips"))
        .join(files, "zone")
        .select("zone", "trips", (F.col("files") <= number // 2).alias("most_files_skipped"))
        .withColumn("days_skip_too", F.lit(widest.first()["widest"] <= number // 2))
    )


_refreshed: dict[tuple[str, str], Lake] = {}


def _refreshed_lake(layers: Layers) -> Lake:
    """A lake whose bronze fares of one month were corrected after it was filled, then refreshed for that month."""
    key = (layers.spark.sparkContext.applicationId, layers.folder)
    if key not in _refreshed:
        lake = Lake(f"{shared_folder(layers.spark)}/refreshed-{time.time_ns()}")
        source, zones = layers.bronze().withColumn("_source_file", F.lit(layers.folder)), stamp_bronze(layers.raw_zones(), RUN_DATE)
        job = Pipeline(layers.spark, lake, source, zones)
        for stage in (job.bronze, job.silver, job.gold):
            stage()
        month = F.date_format("tpep_pickup_datetime", "yyyy-MM") == CORRECTED_MONTH
        fare = F.when(month, F.col("fare_amount") + 1).otherwise(F.col("fare_amount"))
        # written next to the stored trips, which it reads
        lake.write(lake.read(layers.spark, "bronze.trips").withColumn("fare_amount", fare), "bronze.trips")
        job.refresh(CORRECTED_MONTH)
        _refreshed[key] = lake
    return _refreshed[key]


def _refreshed_table(key: str) -> Callable[[Layers], DataFrame]:
    return lambda layers: _refreshed_lake(layers).read(layers.spark, key)


def _partition_refresh(layers: Layers) -> DataFrame:
    """Borough metrics after one month was recomputed from corrected totals."""
    location = _scratch(layers, "refresh")
    keys = ("pickup_date",)
    silver = _stored_table(layers, "silver.trips_cleaned")
    write_table(without_clock(rollups.borough_metrics(silver)), location, keys, few_per_partition=True)
    month = F.date_format("pickup_date", "yyyy-MM") == CORRECTED_MONTH
    corrected = silver.filter(month).withColumn("total_amount", F.col("total_amount") + 1)
    refresh_partitions(without_clock(rollups.borough_metrics(corrected)), location, keys, True)
    return layers.spark.read.parquet(location)


# registry ----------------------------------------------------------------------

_BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {
    # ingestion and silver
    "bronze_trips": Layers.bronze,
    "bronze_union_by_name": _schema_drift,
    "bronze_type_drift": _type_drift,
    "silver_typed": Layers.typed,
    "silver_filtered": lambda s: clean_trips(s.typed()),
    "silver_filter_audit": lambda s: filter_audit(s.typed()),
    "silver_features": Layers.features,
    "zones_clean": lambda s: tidy_zones(s.raw_zones()),
    "silver_enriched": Layers.silver,
    # gold
    "gold_daily": Layers.daily,
    "gold_hourly": Layers.hourly,
    "gold_borough": Layers.borough,
    "gold_borough_revenue": lambda s: rollups.borough_revenue(s.borough()),
    "gold_routes": Layers.routes,
    "gold_top_routes": lambda s: routes.route_preview(s.routes()),
    # analytics
    "kpi_global": lambda s: kpis.global_kpis(s.daily()),
    "kpi_monthly": Layers.monthly,
    "performance_ranking": lambda s: kpis.performance_ranking(s.daily()),
    "daily_trends": Layers.trends,
    "weekday_comparison": lambda s: kpis.weekday_comparison(s.trends()),
    "hourly_heatmap": lambda s: kpis.hourly_heatmap(s.hourly()),
    "peak_hours": lambda s: kpis.peak_hours(s.hourly()),
    "top_routes_volume": lambda s: routes.busiest_routes(s.routes()),
    "top_routes_profit": lambda s: routes.most_profitable_routes(s.routes()),
    "route_efficiency": lambda s: routes.most_efficient_routes(s.routes()),
    "borough_flow": lambda s: routes.borough_flow(s.routes()),
    "borough_summary": lambda s: kpis.borough_summary(s.borough()),
    # quality
    "dq_checks": lambda s: quality.run_checks(s.silver()),
    "dq_summary": lambda s: quality.check_summary(
        quality.run_checks(s.silver())
    ),
    "dq_stats": lambda s: quality.trip_statistics(s.features()),
    "dq_borough_distribution": lambda s: quality.borough_distribution(s.silver()),
    "dq_null_profile": lambda s: quality.null_profile(s.bronze(), REQUIRED_TRIP_COLUMNS),
    "dq_zone_boroughs": lambda s: quality.zone_boroughs(s.raw_zones()),
    "dq_silver_nulls": lambda s: verification.silver_nulls(s.silver()),
    "dq_gold_sanity": lambda s: verification.gold_sanity(s.daily()),
    # checks over the stored layers
    "dq_columns": _required_columns,
    "row_counts": lambda s: verification.row_counts(_stored_tables(s)),
    "dq_min_records": lambda s: verification.minimum_records(_stored_tables(s)),
    "dq_layer_values": lambda s: verification.layer_values(_tagged_tables(s)),
    "dq_layer_status": lambda s: verification.layer_status(
        verification.table_checks(_stored_tables(s))
    ),
    "dq_overall_status": lambda s: verification.overall_status(
        verification.table_checks(_stored_tables(s))
    ),
    "dq_reconcile": lambda s: verification.reconcile(_stored_tables(s)),
    "dq_exports": _exports,
    # marts
    # marts that join results read the stored gold tables, so that no fact is scanned twice
    "mart_daily_with_month": lambda s: marts.daily_with_month(
        kpis.daily_trends(_stored_table(s, "gold.trips_daily_metrics")),
        kpis.monthly_kpis(_stored_table(s, "gold.trips_daily_metrics")),
    ),
    "mart_daily_hourly": lambda s: marts.daily_with_hours(
        _stored_table(s, "gold.trips_daily_metrics"), _stored_table(s, "gold.trips_hourly_metrics")
    ),
    "mart_routes_with_borough": lambda s: marts.routes_with_borough(
        routes.busiest_routes(_stored_table(s, "gold.trips_popular_routes")),
        kpis.borough_summary(_stored_table(s, "gold.trips_borough_metrics")),
    ),
    "mart_revenue_trend": lambda s: marts.revenue_trend(s.monthly()),
    "mart_mom_alerts": lambda s: marts.growth_alerts(s.monthly()),
    "mart_forecast_30d": lambda s: marts.trip_forecast(s.daily()),
    "mart_seasonal_forecast": lambda s: seasonal_forecast(_stored_table(s, "gold.trips_daily_metrics")),
    "mart_revenue_calendar": lambda s: marts.revenue_calendar(s.daily()),
    "mart_peak_top3": lambda s: marts.peak_hour_flags(kpis.peak_hours(s.hourly())),
    "mart_speed_by_hour": lambda s: marts.speed_by_hour(kpis.hourly_heatmap(s.hourly())),
    "mart_flow_share": lambda s: marts.flow_share(routes.borough_flow(s.routes())),
    "mart_top20_routes": lambda s: marts.labelled_top_routes(s.routes()),
    "mart_sliced_hourly": lambda s: rollups.hourly_metrics(
        marts.sliced(_stored_table(s, "silver.trips_cleaned"), SLICE_DATES, SLICE_HOURS, SLICE_WEEKDAYS, SLICE_BOROUGHS)
    ),
    # storage and maintenance
    "file_layout": _file_layout,
    "table_inventory": _table_inventory,
    "compact_table": _compaction,
    "expired_files": _expired,
    "clustered_layout": _clustered,
    "interleaved_layout": _interleaved,
    "partition_refresh": _partition_refresh,
    "refreshed_daily": _refreshed_table("gold.trips_daily_metrics"),
    "refreshed_routes": _refreshed_table("gold.trips_popular_routes"),
    "refreshed_monthly": _refreshed_table("analytics.kpi_dashboard"),
    # slicers and reconciliation
    "cube_hours": _cube_hours,
    "cube_boroughs": _cube_boroughs,
    "cube_weekdays": _cube_weekdays,
    "dq_changed_days": _changed_days,
    "dq_layers_agree": _layers_agree,
}


def all_queries() -> dict[str, Query]:
    return {name: _registered(build) for name, build in _BUILDERS.items()}
