"""The staged batch run: bronze, silver, quality, gold, analytics, maintenance."""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.calendar import year_month
from meterline.layout import BRONZE_STAMPS, LAYERS, REQUIRED_TRIP_COLUMNS, REQUIRED_ZONE_COLUMNS, TABLES
from meterline.operators import cube, kpis, quality, rollups, routes, verification
from meterline.operators.cleaning import audit_of, clean_trips, filter_audit, rejection_mask, typed_trips
from meterline.operators.enrichment import checked_zones, silver_trips
from meterline.operators.features import trip_features
from meterline.plans.maintenance import RETENTION_HOURS, first_line, maintain
from meterline.sources.arrivals import ingest_arrivals, listed_sources, pending_months, set_pending
from meterline.sources.exports import export_csv
from meterline.sources.files import Storage
from meterline.sources.inventory import expired_files, table_inventory
from meterline.sources.lake import (
    FILE_FORMATS,
    Lake,
    ReadBackError,
    WriteResult,
    clustered,
    put_in_place,
    replace_folders,
    try_read_table,
    write_table,
)
from meterline.sources.trips import MONTHLY_PATTERN, find_monthly_files, ingest_trips, ingest_zones, other_files

LEDGER_SCHEMA = (
    "job_name string, job_type string, status string, start_time timestamp, end_time timestamp, duration_sec double, "
    "records_processed long, records_per_sec double, error_message string"
)
SOURCE_SCHEMA = (
    "source_name string, source_type string, location string, format string, description string, "
    "registered_at timestamp, is_active boolean"
)
# Stages whose failure is recorded but does not stop the run.
ADVISORY = ("quality", "maintenance")


class QualityError(RuntimeError):
    """Quality checks failed in a run that asks for them to pass."""

# Stages whose outputs a stage reads.
DEPENDS = {
    "bronze": (),
    "silver": ("bronze",),
    "quality": ("silver",),
    "gold": ("silver",),
    "analytics": ("gold",),
    "maintenance": ("bronze", "silver", "gold", "analytics"),
}
# Stored sums, one folder per month, that the gold tables are merged from.
MONTHLY_SUMS = {"trip_sums": rollups.monthly_trip_sums, "route_sums": rollups.monthly_route_sums}
# Gold tables with a folder per day.
BY_DAY = {
    "gold.trips_hourly_metrics": rollups.hourly_metrics,
    "gold.trips_borough_metrics": rollups.borough_metrics,
}

# Order of the rows in each export (a minus sign means descending); every export is
# bounded by the calendar, the boroughs or a top-k.
EXPORT_ORDER = {
    "kpi_global": ("total_trips_ytd",),
    "kpi_monthly": ("year_month",),
    "performance_ranking": ("-rank_type", "-total_revenue", "pickup_date"),
    "daily_trends": ("pickup_date",),
    "weekday_comparison": ("is_weekend",),
    "hourly_heatmap": ("day_of_week", "pickup_hour"),
    "peak_hours": ("-total_trips_by_hour", "pickup_hour"),
    "top_routes_volume": ("rank_by_volume",),
    "top_routes_profit": ("rank_by_profit",),
    "route_efficiency": ("-revenue_per_mile", *rollups.ROUTE_KEYS),
    "borough_flow": ("flow_type",),
    "borough_summary": ("revenue_rank", "PU_Borough"),
}


@dataclass
class Pipeline:
    """One batch run.  ``trips`` and ``zones`` are raw; ``lake`` receives the layers.

    With ``fail_on_error`` a failed quality check stops the run after its results are stored.
    ``cluster`` names tables that maintenance lays out along some of their columns.
    ``source_version`` tells one state of the raw data from another.
    """

    spark: SparkSession
    lake: Lake
    trips: DataFrame
    zones: DataFrame
    export_root: str | None = None
    fail_on_error: bool = False
    cluster: dict[str, tuple[str, ...]] = field(default_factory=dict)
    source_version: str | None = None
    ledger: list[tuple] = field(default_factory=list)

    # stages ----------------------------------------------------------------

    def bronze(self) -> list[WriteResult]:
        return [
            self.lake.write(self.trips, "bronze.trips"),
            self.lake.write(self.zones, "bronze.taxi_zone_lookup"),
        ]

    def silver(self) -> list[WriteResult]:
        """Cleaned trips, and the audit of what was filtered out, from one scan of bronze.

        Rejected trips go through the same write, into folders by the rules they break, and the
        audit counts what was written: files that a failed task leaves behind are not committed,
        where counters in the plan would count a repeated task again.  Trips are brought together by
        day before derived columns and zone names make their rows several times as wide.
        """
        typed = typed_trips(self.lake.read(self.spark, "bronze.trips"))
        if self.lake.fmt not in FILE_FORMATS:
            written = self.lake.write(self._cleaned(typed), "silver.trips_cleaned")
            self._save(filter_audit(typed), "filter_audit")
            return [written]
        folders = ("_rejected", "pickup_date")
        marked = typed.withColumn("_rejected", rejection_mask())
        dated = marked.withColumn("pickup_date", F.when(F.col("_rejected") == 0, F.col("pickup_date")))
        rows = self._enriched(clustered(dated, folders))
        location, rejected = self.lake.location("silver.trips_cleaned"), self.lake.side_table("rejected_trips")
        staged = f"{location}__new_{time.time_ns()}"
        storage = Storage(self.spark)
        try:
            written = write_table(rows, staged, folders, self.lake.fmt, together=True)
            if not storage.exists(f"{staged}/_rejected=0"):  # no trip was accepted
                empty = rows.drop("_rejected").limit(0).coalesce(1)
                empty.write.format(self.lake.fmt).save(f"{staged}/_rejected=0")
            put_in_place(self.spark, f"{staged}/_rejected=0", location)
            put_in_place(self.spark, staged, rejected)
        except Exception:
            storage.delete(staged)
            raise
        kept = self.lake.read(self.spark, "silver.trips_cleaned").count()
        masks = self.spark.createDataFrame([(0, kept)], "rejected int, n long")
        if storage.has_data(rejected):
            refused = self.rejected_trips().groupBy(F.col("_rejected").alias("rejected")).agg(F.count("*").alias("n"))
            masks = masks.unionByName(refused)
        self._save(audit_of(masks), "filter_audit")
        audit = self.spark.read.parquet(self.lake.side_table("filter_audit")).first()
        if audit["rows_before"] != written.rows:
            raise ReadBackError(f"silver.trips_cleaned: {written.rows} rows written, {audit['rows_before']} read back")
        return [WriteResult(kept, written.seconds)]

    def rejected_trips(self) -> DataFrame:
        """Trips that the last silver stage filtered out, with the mask of the rules they break."""
        rejected = self.spark.read.format(self.lake.fmt).load(self.lake.side_table("rejected_trips"))
        return rejected.withColumn("_rejected", F.col("_rejected").cast("int"))

    def _cleaned(self, typed: DataFrame) -> DataFrame:
        return self._enriched(clean_trips(typed))

    def _enriched(self, trips: DataFrame) -> DataFrame:
        zones = checked_zones(self.lake.read(self.spark, "bronze.taxi_zone_lookup"))
        return silver_trips(trip_features(trips), zones)

    def quality(self) -> list[WriteResult]:
        """Checks and statistics from one pass over silver, the boroughs from another."""
        silver = self.lake.read(self.spark, "silver.trips_cleaned")
        self._save(quality.measured(silver), "quality_measures")
        measures = self.spark.read.parquet(self.lake.side_table("quality_measures"))
        self._save(quality.checks_of(measures), "quality_checks")
        checks = self.spark.read.parquet(self.lake.side_table("quality_checks"))
        self._save(quality.check_summary(checks), "check_summary")
        self._save(quality.statistics_of(measures), "trip_statistics")
        self._save(quality.borough_distribution(silver), "borough_distribution")
        history = checks.select(
            F.lit("quality").alias("job_name"),
            F.lit("silver.trips_cleaned").alias("table_name"),
            F.lit(dt.datetime.now(dt.timezone.utc)).alias("checked_at"),
            "*",
        )
        history.coalesce(1).write.mode("append").parquet(self.lake.side_table("quality_history"))
        failed = self.spark.read.parquet(self.lake.side_table("check_summary")).first()
        if self.fail_on_error and failed["checks_failed"]:
            raise QualityError(f"failed checks: {failed['failed_checks']}")
        return []

    def gold(self) -> list[WriteResult]:
        """Two passes over silver, for the sums by day and by route; the tables are merged from them."""
        silver = self.lake.read(self.spark, "silver.trips_cleaned")
        for name, build in MONTHLY_SUMS.items():
            write_table(build(silver), self.lake.side_table(name), ("month",))
        self._store_cube()
        trips = self._sums("trip_sums")
        return [
            self.lake.write(rollups.daily_metrics(trips, merged=True), "gold.trips_daily_metrics"),
            *[self.lake.write(build(trips, merged=True), key) for key, build in BY_DAY.items()],
            self.lake.write(rollups.route_metrics(self._sums("route_sums"), merged=True), "gold.trips_popular_routes"),
        ]

    def _store_cube(self) -> None:
        """Sums over sets of dimensions for the slicers, a folder per set, from the sums by day."""
        write_table(cube.cube_sums(self._sums("trip_sums")), self.lake.side_table("cube"), ("cube_set",), few_per_partition=True)

    def _sums(self, name: str, months: list[str] | None = None) -> DataFrame:
        """Stored sums, of all months or of some; ``month`` is text also where all look like numbers."""
        silver = self.lake.read(self.spark, "silver.trips_cleaned")
        schema = getattr(rollups, f"monthly_{name}")(silver).schema  # there may be no file to tell it
        sums = self.spark.read.schema(schema).parquet(self.lake.side_table(name))
        return sums.filter(F.col("month").isin(months)) if months else sums

    def analytics(self) -> list[WriteResult]:
        results = analytics_results(self.spark, self.lake)
        stored = {
            "analytics.kpi_global": "kpi_global",
            "analytics.kpi_dashboard": "kpi_monthly",
            "analytics.time_series_trends": "daily_trends",
            "analytics.hourly_heatmap": "hourly_heatmap",
            "analytics.top_routes_analysis": "top_routes_volume",
        }
        written = [
            self.lake.write(results[name], key, allow_schema_change=False) for key, name in stored.items()
        ]
        if self.export_root:
            for name, frame in results.items():
                export_csv(frame, f"{self.export_root}/{name}", export_order(name))
        return written

    def maintenance(self) -> list[WriteResult]:
        self._save(maintain(self.spark, self.lake, cluster=self.cluster), "maintenance")
        self._save(table_inventory(self.spark, self.lake), "lake_tables")
        live = [self.lake.location(key) for key in TABLES]
        cutoff = dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=RETENTION_HOURS)
        folders = [f"{self.lake.root}/{layer}" for layer in LAYERS]
        self._save(expired_files(self.spark, folders, live, cutoff, self.lake.fmt), "expired_files")
        return []

    def refresh(self, *months: str) -> None:
        """Recompute some months (yyyy-MM) from bronze; every other month stays as it is stored.

        Silver, the sums and the tables by day are replaced for these months alone.  Days, routes
        and all analytics add up the stored sums of all months, so that they equal a full run.
        Days that a month no longer has are removed.
        """
        wanted = sorted(set(months))
        if not wanted:
            return
        self._set_done({})  # a later run finds other tables than it wrote
        typed = typed_trips(self._bronze_of(wanted))
        inside = year_month("pickup_date").isin(wanted)
        by_day = [f"{month}-*" for month in wanted]
        self._replace(self._cleaned(typed).filter(inside), "silver.trips_cleaned", by_day)
        silver = self.lake.read(self.spark, "silver.trips_cleaned").filter(_days_of(wanted, "pickup_date", "date"))
        for name, build in MONTHLY_SUMS.items():
            replace_folders(build(silver), self.lake.side_table(name), "month", wanted)
        self._store_cube()
        trips = self._sums("trip_sums", wanted)
        for key, build in BY_DAY.items():
            self._replace(build(trips, merged=True), key, by_day)
        self.lake.write(rollups.daily_metrics(self._sums("trip_sums"), merged=True), "gold.trips_daily_metrics")
        self.lake.write(rollups.route_metrics(self._sums("route_sums"), merged=True), "gold.trips_popular_routes")
        self.analytics()

    def _bronze_of(self, months: list[str]) -> DataFrame:
        """Bronze with a range on the stored pickup time, which the scan skips row groups by."""
        bronze = self.lake.read(self.spark, "bronze.trips")
        kind = dict(bronze.dtypes)["tpep_pickup_datetime"]
        if kind not in ("timestamp", "timestamp_ntz"):
            return bronze
        return bronze.filter(_days_of(months, "tpep_pickup_datetime", kind))

    def _replace(self, df: DataFrame, key: str, values: list[str]) -> None:
        spec = TABLES[key]
        (column,) = spec.partition_by
        replace_folders(df, self.lake.location(key), column, values, spec.few_per_partition, self.lake.fmt)

    # run -------------------------------------------------------------------

    def run(self, resume: bool = False) -> DataFrame:
        """All stages in order; returns one ledger row per stage.

        The ledger is stored also when a stage fails, and the failure is raised.  With ``resume``
        a stage is SKIPPED whose last success had the same fingerprint (code, parameters, the
        version of the sources, the outputs of earlier stages) and whose tables are there, so a
        run that failed goes on where it stopped.  Without ``source_version`` bronze always runs.
        """
        self.ledger = []
        try:
            for stage in (
                self.bronze,
                self.silver,
                self.quality,
                self.gold,
                self.analytics,
                self.maintenance,
            ):
                self._resume(stage) if resume else self._record(stage)
        finally:
            rows = self.spark.createDataFrame(self.ledger, LEDGER_SCHEMA)
            rows.coalesce(1).write.mode("append").parquet(self.lake.side_table("pipeline_jobs"))
        return rows

    def _resume(self, stage: Callable[[], list[WriteResult]]) -> None:
        name, done = stage.__name__, self._done()
        fingerprint = self._fingerprint(name, done)
        storage = Storage(self.spark)
        tables = [self.lake.location(key) for key, spec in TABLES.items() if spec.layer == name]
        if name in done and done[name][0] == fingerprint and all(map(storage.has_data, tables)):
            now = dt.datetime.now(dt.timezone.utc)
            self.ledger.append((name, "batch", "SKIPPED", now, now, 0.0, 0, 0.0, None))
            return
        self._record(stage)

    def _fingerprint(self, name: str, done: dict[str, tuple[str, str]]) -> str:
        """What the outcome of a stage depends on."""
        parameters = {
            "bronze": self.source_version or uuid.uuid4().hex,
            "quality": str(self.fail_on_error),
            "analytics": str(self.export_root),
            "maintenance": str(sorted(self.cluster.items())),
        }
        earlier = [done.get(stage, ("", uuid.uuid4().hex))[1] for stage in DEPENDS[name]]
        return _digest(name, _code_version(), self.lake.fmt, parameters.get(name, ""), *earlier)

    def _done(self) -> dict[str, tuple[str, str]]:
        """Fingerprint and a name for the output of each stage that ended well, one row per stage."""
        stored = try_read_table(self.spark, self.lake.side_table("stage_outputs"))
        return {} if stored is None else {row["stage"]: (row["fingerprint"], row["output"]) for row in stored.collect()}

    def _set_done(self, done: dict[str, tuple[str, str]]) -> None:
        rows = [(stage, *values) for stage, values in done.items()]
        frame = self.spark.createDataFrame(rows, "stage string, fingerprint string, output string")
        write_table(frame.coalesce(1), self.lake.side_table("stage_outputs"))

    def _record(self, stage: Callable[[], list[WriteResult]]) -> None:
        name, start = stage.__name__, dt.datetime.now(dt.timezone.utc)

        def entry(status: str, rows: int, error: str | None) -> None:
            end = dt.datetime.now(dt.timezone.utc)
            seconds = (end - start).total_seconds()
            self.ledger.append((name, "batch", status, start, end, seconds, rows, rows / max(seconds, 1e-9), error))

        done = self._done()
        if done.pop(name, None):  # a stage that is cut off has to run again
            self._set_done(done)
        try:
            written = stage()
        except Exception as error:
            entry("FAILED", 0, first_line(error))
            if name not in ADVISORY or isinstance(error, QualityError):
                raise
            return
        self._set_done(done | {name: (self._fingerprint(name, done), uuid.uuid4().hex)})
        entry("SUCCESS", sum(result.rows for result in written), None)

    def _save(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(self.lake.side_table(name))


def _digest(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


@cache
def _code_version() -> str:
    """A digest of the modules that the stages are made of."""
    package = Path(__file__).resolve().parents[1]
    modules = [package / name for name in ("layout.py", "session.py")]
    modules += sorted(p for name in ("functions", "operators", "plans", "sources") for p in (package / name).glob("*.py"))
    return _digest(*[path.read_text(encoding="utf-8") for path in modules])


def _days_of(months: list[str], column: str, kind: str) -> Column:
    """Whether a date or time lies in one of the months, as ranges that a scan can use."""
    ranges = []
    for month in months:
        first = dt.date.fromisoformat(f"{month}-01")
        following = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        start, end = (F.lit(str(day)).cast(kind) for day in (first, following))
        ranges.append((F.col(column) >= start) & (F.col(column) < end))
    return reduce(Column.__or__, ranges)


def export_order(name: str) -> list[Column]:
    return [
        F.col(key[1:]).desc_nulls_last() if key.startswith("-") else F.col(key).asc_nulls_first()
        for key in EXPORT_ORDER[name]
    ]


def analytics_results(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """All analytics tables and exports over the stored gold layer, by export name."""
    daily, hourly, borough, route = (
        lake.read(spark, key)
        for key in (
            "gold.trips_daily_metrics",
            "gold.trips_hourly_metrics",
            "gold.trips_borough_metrics",
            "gold.trips_popular_routes",
        )
    )
    trends = kpis.daily_trends(daily)
    return {
        "kpi_global": kpis.global_kpis(daily),
        "kpi_monthly": kpis.monthly_kpis(daily),
        "performance_ranking": kpis.performance_ranking(daily),
        "daily_trends": trends,
        "weekday_comparison": kpis.weekday_comparison(trends),
        "hourly_heatmap": kpis.hourly_heatmap(hourly),
        "peak_hours": kpis.peak_hours(hourly),
        "top_routes_volume": routes.busiest_routes(route),
        "top_routes_profit": routes.most_profitable_routes(route),
        "route_efficiency": routes.most_efficient_routes(route),
        "borough_flow": routes.borough_flow(route),
        "borough_summary": kpis.borough_summary(borough),
    }


def run_from_files(
    spark: SparkSession,
    raw_folder: str,
    root: str,
    run_date: dt.date,
    export_root: str | None = None,
    fmt: str = "parquet",
    pattern: str = MONTHLY_PATTERN,
    fail_on_error: bool = False,
    resume: bool = False,
) -> DataFrame:
    """The whole run over monthly Parquet files and ``taxi_zone_lookup.csv`` in a folder.

    With ``resume`` stages whose inputs, code and parameters have not changed are skipped.  The
    registry of sources names what was read, and as inactive what the pattern left out.
    """
    lake, months = Lake(root, fmt), find_monthly_files(spark, raw_folder, pattern)
    lookup = f"{raw_folder}/taxi_zone_lookup.csv"
    registered = [(path, "trips", path, "parquet", "monthly trips", True) for path in months]
    registered += [(path, "trips", path, "parquet", "not read", False) for path in other_files(spark, raw_folder, pattern)]
    registered.append((lookup, "zones", lookup, "csv", "zone lookup", True))
    source_registry(spark, registered).write.mode("overwrite").parquet(lake.side_table("data_sources"))
    trips, zones = ingest_trips(spark, months, run_date), ingest_zones(spark, lookup, run_date)
    version = source_version(spark, [*months, lookup], run_date)
    return Pipeline(spark, lake, trips, zones, export_root, fail_on_error, source_version=version).run(resume)


def source_version(spark: SparkSession, paths: list[str], run_date: dt.date) -> str:
    """Tells whether any of some sources, or the date stamped on them, has changed."""
    listed = listed_sources(spark, paths).select("source", "fingerprint").orderBy("source").collect()
    return _digest(str(run_date), *[part for row in listed for part in row])


def update_from_files(
    spark: SparkSession,
    raw_folder: str,
    root: str,
    run_date: dt.date,
    export_root: str | None = None,
    fmt: str = "parquet",
    pattern: str = MONTHLY_PATTERN,
) -> list[str]:
    """Bring a lake up to date with a folder of monthly files; returns the months recomputed.

    Months are read when they are new or have changed, and only the months that their trips fall
    into are recomputed.  The first run, and one after the zone lookup changed, computes all
    layers.  A run that was cut off anywhere is finished by the next.
    """
    lake, lookup = Lake(root, fmt), f"{raw_folder}/taxi_zone_lookup.csv"
    job = Pipeline(spark, lake, spark.range(0), ingest_zones(spark, lookup, run_date), export_root)
    ingest_arrivals(spark, lake, raw_folder, run_date, pattern)
    months, former = pending_months(spark, lake), lake.find(spark, "bronze.taxi_zone_lookup")
    changed = former is None or not _same_zones(former, job.zones)
    if changed or lake.find(spark, "analytics.kpi_global") is None:
        lake.write(job.zones, "bronze.taxi_zone_lookup")
        for stage in (job.silver, job.quality, job.gold, job.analytics):
            stage()
    else:
        job.refresh(*months)
    set_pending(spark, lake, [])
    return months


def _same_zones(former: DataFrame, zones: DataFrame) -> bool:
    names = [name for name in zones.columns if not name.startswith("_")]
    if any(name not in former.columns for name in names):
        return False
    return former.select(names).exceptAll(zones.select(names)).isEmpty() and zones.select(names).exceptAll(
        former.select(names)
    ).isEmpty()


def source_registry(spark: SparkSession, sources: list[tuple[str, str, str, str, str, bool]]) -> DataFrame:
    """Registered sources: name (the last part of a path), type, location, format, description, active."""
    now = dt.datetime.now(dt.timezone.utc)
    rows = [(name.rpartition("/")[2], *rest[:-1], now, rest[-1]) for name, *rest in sources]
    return spark.createDataFrame(rows, SOURCE_SCHEMA)


def stored_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame | None]:
    return {key: lake.find(spark, key) for key in TABLES}


def verify_bronze(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Checks on the ingested tables: columns, null shares, layer tags, boroughs."""
    trips, zones = (lake.read(spark, f"bronze.{name}") for name in ("trips", "taxi_zone_lookup"))
    return {
        "columns": quality.required_columns(
            {
                "bronze.trips": (trips, REQUIRED_TRIP_COLUMNS + BRONZE_STAMPS),
                "bronze.taxi_zone_lookup": (zones, REQUIRED_ZONE_COLUMNS),
            }
        ),
        "nulls": quality.null_profile(trips, REQUIRED_TRIP_COLUMNS),
        "layers": verification.layer_values({"bronze.trips": trips, "bronze.taxi_zone_lookup": zones}),
        "boroughs": quality.zone_boroughs(zones),
    }


def verify(spark: SparkSession, lake: Lake) -> DataFrame:
    """Check every stored table by itself, keep the check rows, and return the verdict per layer.

    A table that fails while it is read fails alone.
    """
    location, rows = lake.side_table("verification"), []
    for key in TABLES:
        try:
            rows += verification.table_checks({key: lake.find(spark, key)}).collect()
        except Exception:
            rows.append((key, "readable", 0, quality.FAILED))
    spark.createDataFrame(rows, verification.CHECKS).coalesce(1).write.mode("overwrite").parquet(location)
    return verification.layer_status(spark.read.parquet(location))
