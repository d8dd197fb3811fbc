"""The stored layers: tables by key under one root."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterline.layout import TABLES, TableSpec
from meterline.sources.files import Storage

# Formats whose tables are nothing but their files, so that they can be swapped and compacted here.
FILE_FORMATS = ("parquet", "orc")
MAX_RECORDS_PER_FILE = 1_000_000
# Shuffled bytes a task of a write takes: several days of an ordinary source stay in one
# task and one file each, and a hot day is split at this size.  A task sorts its rows, which
# take some ten times as much memory, and has to hold them beside others without spilling.
WRITE_TASK_BYTES = 32 * 1024 * 1024


class ReadBackError(RuntimeError):
    """A stored table does not hold the rows that were written."""


class SchemaChangeError(ValueError):
    """An overwrite would change the schema of a table that does not allow it."""


@contextmanager
def rebalanced_to(spark: SparkSession, task_bytes: int) -> Iterator[None]:
    """Size adaptive execution aims at for the tasks of a REBALANCE."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(task_bytes))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@dataclass(frozen=True)
class WriteResult:
    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def clustered(df: DataFrame, keys: tuple[str, ...], few_per_key: bool = False) -> DataFrame:
    """Bring equal keys together for a partitioned write.

    REBALANCE lets adaptive execution split a hot key over several tasks and
    merge small ones, where ``repartition`` would give a hot key a single task.
    An aggregate with few rows per key has no hot keys, only many small files; a
    fixed partition count keeps all cores writing them.
    """
    if not keys:
        return df
    if few_per_key:
        return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)
    return df.hint("rebalance", *[F.col(key) for key in keys])


def write_table(
    df: DataFrame,
    location: str,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    allow_schema_change: bool = True,
    few_per_partition: bool = False,
    task_bytes: int = WRITE_TASK_BYTES,
    together: bool = False,
) -> WriteResult:
    """Overwrite a table; the rows written are counted by the write itself.

    A table of plain files is written next to the old one and put in its place when it is
    whole, so a failed write leaves the old table as it was.  With ``together`` the rows of a
    partition have been brought together before.
    """
    if not allow_schema_change:
        _require_same_schema(df, location, fmt)
    written = Observation()
    gathered = df if together else clustered(df, partition_by, few_per_partition)
    counted = gathered.observe(written, F.count(F.lit(1)).alias("rows"))
    started = time.monotonic()
    writer = counted.write.format(fmt).mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if allow_schema_change:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark, storage = df.sparkSession, Storage(df.sparkSession)
    beside = fmt in FILE_FORMATS and storage.exists(location)
    target = f"{location}__new_{time.time_ns()}" if beside else location
    try:
        with rebalanced_to(spark, task_bytes):
            writer.save(target)
        if beside:
            previous = target.replace("__new_", "__old_")
            swap_in(spark, target, location, previous)
            storage.delete(previous)
            spark.catalog.refreshByPath(location)
    except Exception:
        if beside:
            storage.delete(target)
        raise
    return WriteResult(written.get["rows"], time.monotonic() - started)


def _require_same_schema(df: DataFrame, location: str, fmt: str) -> None:
    existing = try_read_table(df.sparkSession, location, fmt)
    if existing is None:
        return

    def shape(frame: DataFrame) -> set[tuple[str, str]]:
        return {(field.name, field.dataType.simpleString()) for field in frame.schema}

    if shape(existing) != shape(df):
        raise SchemaChangeError(f"{location}: {sorted(shape(existing) ^ shape(df))} differ")


def data_pattern(fmt: str) -> str:
    """How the data files of a format are named; transactional formats keep Parquet files."""
    return f"*.{fmt}" if fmt in ("orc", "csv", "json", "avro") else "*.parquet"


def try_read_table(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when there is nothing; a table that cannot be read is an error."""
    storage = Storage(spark)
    if not storage.exists(location) or (fmt in FILE_FORMATS and not storage.has_data(location)):
        return None
    return spark.read.format(fmt).load(location)


def swap_in(spark: SparkSession, fresh: str, location: str, previous: str) -> None:
    """Put a folder in the place of another, which stays as ``previous``; undone on failure."""
    storage = Storage(spark)
    storage.rename(location, previous)
    try:
        storage.rename(fresh, location)
    except Exception:
        storage.rename(previous, location)
        raise


def put_in_place(spark: SparkSession, fresh: str, location: str) -> None:
    """Make a folder the table at ``location``, where there may be one already."""
    storage = Storage(spark)
    if storage.exists(location):
        previous = f"{location}__old_{time.time_ns()}"
        swap_in(spark, fresh, location, previous)
        storage.delete(previous)
    else:
        storage.make_folder(location.rpartition("/")[0])
        storage.rename(fresh, location)
    spark.catalog.refreshByPath(location)


def refresh_partitions(
    df: DataFrame,
    location: str,
    partition_by: tuple[str, ...],
    few_per_partition: bool = False,
    fmt: str = "parquet",
) -> None:
    """Replace only the partitions that occur in ``df``; all others stay as they are."""
    writer = (
        clustered(df, partition_by, few_per_partition)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partition_by)
    )
    with rebalanced_to(df.sparkSession, WRITE_TASK_BYTES):
        writer.save(location)
    df.sparkSession.catalog.refreshByPath(location)


def replace_folders(
    df: DataFrame,
    location: str,
    partition_by: str,
    replaced: list[str],
    few_per_partition: bool = False,
    fmt: str = "parquet",
) -> WriteResult:
    """Put the partitions of ``df`` in the place of those whose value matches one of some globs.

    ``df`` is computed once, next to the table.  Then folders change places one by one, and
    those without new rows go; a run that was cut off can be repeated.  Only for tables of plain
    files: folders moved by hand would damage a table with a log of its own.
    """
    if fmt not in FILE_FORMATS:
        raise ValueError(f"tables of {fmt} are refreshed by the format's own commands")
    spark, storage, stamp = df.sparkSession, Storage(df.sparkSession), time.time_ns()
    fresh, previous = f"{location}__new_{stamp}", f"{location}__old_{stamp}"
    try:
        result = write_table(df, fresh, (partition_by,), fmt, few_per_partition=few_per_partition)
    except Exception:
        storage.delete(fresh)
        raise

    def folders(root: str, values: list[str]) -> set[str]:
        return {path.rpartition("/")[2] for value in values for path in storage.matching(f"{root}/{partition_by}={value}")}

    new, old = folders(fresh, ["*"]), folders(location, replaced)
    storage.make_folder(location)
    storage.make_folder(previous)
    for name in sorted(new | old):
        if storage.exists(f"{location}/{name}"):
            storage.rename(f"{location}/{name}", f"{previous}/{name}")
        if name in new:
            storage.rename(f"{fresh}/{name}", f"{location}/{name}")
    storage.delete(fresh)
    storage.delete(previous)
    spark.catalog.refreshByPath(location)
    return result


def preview(df: DataFrame, columns: tuple[str, ...], n: int = 5, *order_by: str) -> DataFrame:
    """A few rows of some columns, the first in an order when one is named."""
    return (df.orderBy(*order_by) if order_by else df).limit(n).select(*columns)


@dataclass(frozen=True)
class Lake:
    """Tables of the registry under ``root``, in any format the session can read."""

    root: str
    fmt: str = "parquet"
    schema_name: str = "default"

    def location(self, key: str) -> str:
        spec = TABLES[key]
        return f"{self.root}/{spec.layer}/{spec.name}"

    def side_table(self, name: str) -> str:
        """Location of an operational table (ledger, check results, inventory)."""
        return f"{self.root}/_operations/{name}"

    def read(self, spark: SparkSession, key: str) -> DataFrame:
        return spark.read.format(self.fmt).load(self.location(key))

    def find(self, spark: SparkSession, key: str) -> DataFrame | None:
        return try_read_table(spark, self.location(key), self.fmt)

    def write(self, df: DataFrame, key: str, allow_schema_change: bool = True) -> WriteResult:
        spec: TableSpec = TABLES[key]
        result = write_table(
            df,
            self.location(key),
            spec.partition_by,
            self.fmt,
            allow_schema_change,
            spec.few_per_partition,
        )
        # a count without columns reads file footers only
        stored = self.read(df.sparkSession, key).count()
        if stored != result.rows:
            raise ReadBackError(f"{key}: {result.rows} rows written, {stored} read back")
        return result
