"""Ingestion of the months that are new or have changed since the last run.

A manifest keeps, per monthly source, a fingerprint of its files (path, size, time).  It is
compared with the listing, and only sources that differ are read.  Their rows are staged and
moved into the bronze table under names that say which source and which version they hold, so a
run that was cut off anywhere is repeated without adding a row twice.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.calendar import year_month
from meterline.operators.cleaning import CONVERSIONS
from meterline.operators.stamps import stamp_bronze
from meterline.sources.files import Storage
from meterline.sources.inventory import stored_files
from meterline.sources.lake import FILE_FORMATS, MAX_RECORDS_PER_FILE, Lake, swap_in, try_read_table, write_table
from meterline.sources.trips import MONTHLY_PATTERN, find_monthly_files, read_months, union_months

MANIFEST, PENDING = "ingested_sources", "pending_months"
_MANIFEST = "source string, fingerprint string, path string, files long, size_bytes long, ingested_at timestamp"
_ID_LENGTH = 12


@dataclass(frozen=True)
class Arrival:
    """A monthly source that the bronze table does not hold in its present version."""

    source: str
    path: str
    fingerprint: str
    files: int
    size_bytes: int

    @property
    def source_id(self) -> str:
        return _short(self.source)

    @property
    def file_prefix(self) -> str:
        return f"{self.source_id}-{self.fingerprint[:_ID_LENGTH]}-"


def _short(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:_ID_LENGTH]


def _source_of(path: str, names: list[str]) -> Column:
    """The monthly file or folder a listed path belongs to, as the listing spells it."""
    spelled = [*names, *[quote(name) for name in names]]
    last, above = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(last.isin(spelled), last).otherwise(above)


def listed_sources(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source, fingerprint, files, size_bytes) per monthly path, from one distributed listing."""
    names = [path.rpartition("/")[2] for path in paths]
    file = F.concat_ws(" ", "file_path", F.col("size_bytes").cast("string"), F.unix_micros("modified").cast("string"))
    files = stored_files(spark, paths, "*")
    visible = ~F.substring_index("file_path", "/", -1).rlike("^[_.]")
    return files.filter(visible).groupBy(_source_of("file_path", names).alias("source")).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(file)), "\n"), 256).alias("fingerprint"),
        F.count("*").alias("files"),
        F.sum("size_bytes").alias("size_bytes"),
    )


def manifest(spark: SparkSession, lake: Lake) -> DataFrame:
    """What the bronze table holds; empty without one."""
    known = try_read_table(spark, lake.side_table(MANIFEST))
    return spark.createDataFrame([], _MANIFEST) if known is None else known


def arrivals(spark: SparkSession, lake: Lake, paths: list[str]) -> list[Arrival]:
    """Sources that are new or have changed; one row per month reaches the driver."""
    by_name = {path.rpartition("/")[2]: path for path in paths}
    new = listed_sources(spark, paths).join(manifest(spark, lake), ["source", "fingerprint"], "left_anti")
    return [
        Arrival(row["source"], by_name.get(row["source"]) or by_name[unquote(row["source"])], *row[1:])
        for row in new.select("source", "fingerprint", "files", "size_bytes").orderBy("source").collect()
    ]


def pending_months(spark: SparkSession, lake: Lake) -> list[str]:
    """Months whose trips have changed in bronze and are not yet recomputed."""
    stored = try_read_table(spark, lake.side_table(PENDING))
    return [] if stored is None else sorted(row["month"] for row in stored.collect())


def set_pending(spark: SparkSession, lake: Lake, months: list[str]) -> None:
    frame = spark.createDataFrame([(month,) for month in sorted(set(months))], "month string")
    write_table(frame.coalesce(1), lake.side_table(PENDING))


def ingest_arrivals(
    spark: SparkSession, lake: Lake, folder: str, run_date: dt.date, pattern: str = MONTHLY_PATTERN
) -> list[Arrival]:
    """Bring the bronze trips up to date with the monthly files of a folder.

    Only sources that differ from the manifest are read; a changed one takes the place of its
    former rows.  Months that gain or lose trips are noted as pending before bronze changes.  A
    source that needs a wider schema than the table has rewrites it once.  A table without a
    manifest is built anew.
    """
    if lake.fmt not in FILE_FORMATS:
        raise ValueError(f"tables of {lake.fmt} are extended by the format's own commands")
    paths = find_monthly_files(spark, folder, pattern)
    new = arrivals(spark, lake, paths)
    if not new:
        return []
    names = [arrival.source for arrival in new]
    ids = F.create_map(*[F.lit(x) for a in new for x in (a.source, a.source_id)])
    fresh = stamp_bronze(read_months(spark, [arrival.path for arrival in new]), run_date)
    fresh = fresh.withColumn("_unit", ids[_source_of("_source_file", names)])

    location, stamp = lake.location("bronze.trips"), time.time_ns()
    known = manifest(spark, lake)
    existing = None if known.isEmpty() else lake.find(spark, "bronze.trips")
    rows, whole = fresh, True
    if existing is not None:
        united = union_months([existing.withColumn("_unit", F.lit("")).limit(0), fresh])
        if {(f.name, f.dataType) for f in united.drop("_unit").schema} == {(f.name, f.dataType) for f in existing.schema}:
            rows, whole = united, False
        else:  # the table is read once more to take the wider schema
            unit = F.substring("_metadata.file_name", 1, _ID_LENGTH)
            kept = existing.withColumn("_unit", unit).filter(~F.col("_unit").isin([a.source_id for a in new]))
            rows = union_months([kept, fresh])
    staged, storage = f"{location}__new_{stamp}", Storage(spark)
    writer = rows.write.format(lake.fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    try:
        writer.partitionBy("_unit").save(staged)
        _note_pending(spark, lake, staged, new, existing)
        _move_in(spark, lake, staged, new, whole)
    except Exception:
        storage.delete(staged)
        raise
    _record(spark, lake, new, known if not whole or existing is not None else known.limit(0))
    return new


def _note_pending(spark: SparkSession, lake: Lake, staged: str, new: list[Arrival], existing: DataFrame | None) -> None:
    """Add the months of the staged rows, and of those that they replace, to the pending ones."""
    day = F.expr(CONVERSIONS["pickup_date"])
    units = [arrival.source_id for arrival in new]
    changed = spark.read.format(lake.fmt).load(staged).filter(F.col("_unit").isin(units)).select(day.alias("day"))
    if existing is not None:
        replaced = existing.filter(F.substring("_metadata.file_name", 1, _ID_LENGTH).isin(units))
        changed = changed.unionByName(replaced.select(day.alias("day")))
    months = changed.select(year_month("day").alias("month")).filter("month IS NOT NULL").distinct().collect()
    set_pending(spark, lake, [row["month"] for row in months] + pending_months(spark, lake))


def _move_in(spark: SparkSession, lake: Lake, staged: str, new: list[Arrival], whole: bool) -> None:
    """Move staged files into the table, or into a new one that takes its place."""
    storage, location = Storage(spark), lake.location("bronze.trips")
    prefixes = {arrival.source_id: arrival.file_prefix for arrival in new}
    target = f"{staged}_flat" if whole else location
    storage.make_folder(target)
    if not whole:  # former versions go first: a reader in between misses rows but sees none twice
        for unit in prefixes:
            for file in storage.matching(f"{location}/{unit}-*"):
                storage.delete(file)
    for folder in storage.matching(f"{staged}/_unit=*"):
        unit = folder.rpartition("=")[2]
        for file in storage.data_files(folder):
            storage.rename(file, f"{target}/{prefixes.get(unit, f'{unit}-kept-')}{file.rpartition('/')[2]}")
    storage.delete(staged)
    if whole and storage.exists(location):
        previous = f"{staged}_old"
        swap_in(spark, target, location, previous)
        storage.delete(previous)
    elif whole:
        storage.rename(target, location)
    spark.catalog.refreshByPath(location)


def _record(spark: SparkSession, lake: Lake, new: list[Arrival], known: DataFrame) -> None:
    now = dt.datetime.now(dt.timezone.utc)
    rows = [(a.source, a.fingerprint, a.path, a.files, a.size_bytes, now) for a in new]
    kept = known.filter(~F.col("source").isin([arrival.source for arrival in new]))
    write_table(kept.unionByName(spark.createDataFrame(rows, _MANIFEST)).coalesce(1), lake.side_table(MANIFEST))
