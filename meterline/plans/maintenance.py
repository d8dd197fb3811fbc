"""Compaction and clustering of stored tables as ordinary Spark jobs."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.layout import ANALYTICS, TABLES
from meterline.operators.clustering import interleaved_key
from meterline.sources.files import Storage
from meterline.sources.inventory import folder_layout, layout_summary, stored_files
from meterline.sources.lake import FILE_FORMATS, Lake, data_pattern, swap_in, try_read_table

# Default file size (within both published ranges) and retention.
TARGET_BYTES = 256 * 1024 * 1024
RETENTION_HOURS = 168
# Most bytes of a file whose rows a task sorts before it writes them: they take some ten times as much memory.
SORTED_BYTES = 32 * 1024 * 1024
CLUSTER_KEYS = ("pickup_date", "PULocationID")

REPORT_SCHEMA = (
    "table_name string, status string, record_count long, files_before long, files_after long, "
    "reduction long, seconds double, message string"
)


@dataclass
class CompactionReport:
    table_name: str
    status: str
    record_count: int = 0
    files_before: int = 0
    files_after: int = 0
    reduction: int = 0
    seconds: float = 0.0
    message: str = ""


def fragmented(folders: DataFrame) -> DataFrame:
    """Folders with more files than they need, some of which fit together.

    Half as many again are let pass where several are needed.
    """
    most = F.when(F.col("needed") == 1, 1).otherwise(F.ceil(F.col("needed") * 1.5))
    return folders.filter((F.col("files") > most) & (F.col("small") > 1))


def compact_table(
    spark: SparkSession,
    name: str,
    location: str,
    partition_by: tuple[str, ...] = (),
    target_bytes: int = TARGET_BYTES,
    fmt: str = "parquet",
) -> CompactionReport:
    """Rewrite the fragmented folders of a table into fewer files, verify them, then swap.

    Whole files are packed into tasks up to the target size, so no row is shuffled.  Folders
    that are compact keep their files.  The previous files stay in a sibling folder
    until retention expires, so a failure at any point leaves a complete copy.
    """
    started = time.monotonic()

    def report(status: str, **values) -> CompactionReport:
        return CompactionReport(name, status, seconds=time.monotonic() - started, **values)

    if fmt not in FILE_FORMATS:
        return report("SKIPPED", message=f"tables of {fmt} are compacted by the format's own commands")
    if try_read_table(spark, location, fmt) is None:
        return report("SKIPPED", message="not found")
    before = layout_summary(spark, location, target_bytes, fmt).first()
    counts = {"record_count": before["record_count"], "files_before": before["file_count"]}
    # the names of folders, which the driver lists anyway
    folders = fragmented(folder_layout(spark, location, target_bytes, fmt)).collect()
    if not folders:
        return report("SUCCESS", **counts, files_after=before["file_count"], message="already compact")

    stamp = time.time_ns()
    fresh, previous = f"{location}__new_{stamp}", f"{location}__old_{stamp}"
    try:
        _rewrite(spark, location, fresh, folders, partition_by, target_bytes, fmt)
        _swap_folders(spark, location, fresh, previous, [row["folder"] for row in folders], partition_by)
        after = layout_summary(spark, location, target_bytes, fmt).first()
    except Exception as error:  # reported, the run goes on with the next table
        return report("FAILED", **counts, message=first_line(error))
    return report(
        "SUCCESS",
        **counts,
        files_after=after["file_count"],
        reduction=before["file_count"] - after["file_count"],
    )


@contextmanager
def packed_to(spark: SparkSession, task_bytes: int) -> Iterator[None]:
    """Scans whose tasks take whole files, the largest first, up to ``task_bytes`` together."""
    settings = {
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",  # do not make tasks smaller to occupy all cores
        "spark.sql.maxConcurrentOutputFileWriters": "2",  # a task writes one folder: nothing to sort
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# Folders whose scans make one job: every scan packs its own files, so no task spans two folders.
_FOLDERS_A_JOB = 64


def _rewrite(
    spark: SparkSession,
    location: str,
    fresh: str,
    folders: list[Row],
    partition_by: tuple[str, ...],
    target_bytes: int,
    fmt: str,
) -> None:
    """Copy the rows of some folders into files of about the target size, without a shuffle.

    Each scan packs the files of one folder into tasks, and each task writes one file.  Rows of
    many small files take fewer bytes in a large one: how many is tried on one file beforehand.
    """
    schema = spark.read.format(fmt).load(location).schema
    paths = [f"{location}{_within(row['folder'], partition_by)}" for row in folders]
    largest = max(range(len(folders)), key=lambda i: folders[i]["bytes"])
    read = target_bytes
    if folders[largest]["bytes"] > target_bytes:
        stored_columns = StructType([field for field in schema if field.name not in partition_by])
        trial = spark.read.format(fmt).schema(stored_columns)
        read = int(target_bytes / _shrinkage(trial, paths[largest], f"{fresh}_trial", target_bytes, fmt))

    def scan(path: str) -> DataFrame:
        return spark.read.format(fmt).schema(schema).option("basePath", location).load(path)

    records = 0
    with packed_to(spark, read):
        for low in range(0, len(paths), _FOLDERS_A_JOB):
            rows = reduce(DataFrame.unionByName, map(scan, paths[low : low + _FOLDERS_A_JOB]))
            records += rows.count()
            writer = rows.write.format(fmt).mode("append")
            (writer.partitionBy(*partition_by) if partition_by else writer).save(fresh)
    copied = spark.read.format(fmt).schema(schema).load(fresh).count()
    if copied != records:
        raise RuntimeError(f"{copied} of {records} records rewritten")


def _shrinkage(reader: DataFrameReader, folder: str, trial: str, target_bytes: int, fmt: str) -> float:
    """Bytes of one file of about the target size for each byte of the files that it replaces."""
    spark = SparkSession.active()
    reached = F.sum("size_bytes").over(Window.orderBy("file_path"))  # one row per file of a folder
    files = stored_files(spark, folder, data_pattern(fmt)).withColumn("reached", reached)
    some = files.filter(F.col("reached") - F.col("size_bytes") < target_bytes).select("file_path", "size_bytes").collect()
    try:
        reader.load([unquote(row["file_path"]) for row in some]).coalesce(1).write.format(fmt).save(trial)
        made = stored_files(spark, trial, data_pattern(fmt)).agg(F.sum("size_bytes")).first()[0]
    finally:
        Storage(spark).delete(trial)
    return max(made / sum(row["size_bytes"] for row in some), 0.1)


def _within(folder: str, partition_by: tuple[str, ...]) -> str:
    """The partition part of a listed folder; the listing escapes paths."""
    names = unquote(folder).split("/")[len(folder.split("/")) - len(partition_by) :] if partition_by else []
    return "".join(f"/{name}" for name in names)


def _swap_folders(
    spark: SparkSession, location: str, fresh: str, previous: str, folders: list[str], partition_by: tuple[str, ...]
) -> None:
    """Put each rewritten folder in the place of its old one, which moves below ``previous``."""
    storage = Storage(spark)
    for folder in folders:
        within = _within(folder, partition_by)
        if within:
            storage.make_folder(f"{previous}{within}".rpartition("/")[0])
        swap_in(spark, f"{fresh}{within}", f"{location}{within}", f"{previous}{within}")
    if storage.exists(fresh):
        storage.delete(fresh)
    spark.catalog.refreshByPath(location)


def reports_frame(spark: SparkSession, reports: list[CompactionReport]) -> DataFrame:
    return spark.createDataFrame([asdict(report) for report in reports], REPORT_SCHEMA)


def maintain(
    spark: SparkSession,
    lake: Lake,
    target_bytes: int = TARGET_BYTES,
    cluster: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Compact every bronze, silver and gold table; one report row each.

    ``cluster`` names tables that are laid out along some of their columns instead.
    """
    reports = []
    for key, spec in TABLES.items():
        where = spark, key, lake.location(key)
        if cluster and key in cluster:
            reports.append(cluster_table(*where, cluster[key], spec.partition_by, target_bytes, lake.fmt))
        elif spec.layer != ANALYTICS:
            reports.append(compact_table(*where, spec.partition_by, target_bytes, lake.fmt))
    return reports_frame(spark, reports)


def cluster_table(
    spark: SparkSession,
    name: str,
    location: str,
    columns: tuple[str, ...],
    partition_by: tuple[str, ...] = (),
    target_bytes: int = TARGET_BYTES,
    fmt: str = "parquet",
) -> CompactionReport:
    """Rewrite a table so that files are narrow in each of ``columns``, verify it, then swap.

    The previous files stay in a sibling folder until retention expires.
    """
    started = time.monotonic()

    def report(status: str, **values) -> CompactionReport:
        return CompactionReport(name, status, seconds=time.monotonic() - started, **values)

    if fmt not in FILE_FORMATS:
        return report("SKIPPED", message=f"tables of {fmt} are clustered by the format's own commands")
    rows = try_read_table(spark, location, fmt)
    if rows is None:
        return report("SKIPPED", message="not found")
    before = layout_summary(spark, location, target_bytes, fmt).first()
    counts = {"record_count": before["record_count"], "files_before": before["file_count"]}
    stamp = time.time_ns()
    fresh, previous = f"{location}__new_{stamp}", f"{location}__old_{stamp}"
    try:
        files = max(-(-before["size_bytes"] // min(target_bytes, SORTED_BYTES)), 1)
        write_interleaved(rows, fresh, files, columns, partition_by, fmt)
        copied = spark.read.format(fmt).load(fresh).count()
        if copied != before["record_count"]:
            raise RuntimeError(f"{copied} of {before['record_count']} records rewritten")
        swap_in(spark, fresh, location, previous)
        spark.catalog.refreshByPath(location)
        after = layout_summary(spark, location, target_bytes, fmt).first()
    except Exception as error:  # reported, the run goes on with the next table
        Storage(spark).delete(fresh)
        return report("FAILED", **counts, message=first_line(error))
    left = after["file_count"]
    return report("SUCCESS", **counts, files_after=left, reduction=before["file_count"] - left, message="clustered")


def write_interleaved(
    df: DataFrame,
    location: str,
    files: int,
    columns: tuple[str, ...] = CLUSTER_KEYS,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
) -> None:
    """Write about ``files`` files, each of which holds a small range of every one of ``columns``.

    Partition columns come first.  A row number within the scan extends the key, so that rows
    alike in all columns spread over several files.
    """
    keyed = df.withColumns({"_key": interleaved_key(df, columns), "_row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(files, *partition_by, "_key", "_row")
    writer = ordered.sortWithinPartitions(*partition_by, "_key").drop("_key", "_row").write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(location)


def first_line(error: BaseException) -> str:
    """The first line of an error's text, or its kind when it has none."""
    return next(iter(str(error).splitlines()), "") or type(error).__name__


def write_clustered(
    trips: DataFrame, location: str, files: int, keys: tuple[str, ...] = CLUSTER_KEYS
) -> None:
    """Write trips range-clustered by ``keys`` so min/max statistics skip files.

    A row number within the scan extends the range key: a hot day or zone, even
    one made of identical rows, spreads over several ranges.
    """
    numbered = trips.withColumn("_row", F.monotonically_increasing_id())
    (
        numbered.repartitionByRange(files, *keys, "_row")
        .sortWithinPartitions(*keys)
        .drop("_row")
        .write.mode("overwrite")
        .parquet(location)
    )
